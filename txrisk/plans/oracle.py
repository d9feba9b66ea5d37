"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

from txrisk.plans.queries import CENTRES, CUT, GRID, INTERCEPT, MANIFEST, NUMBERS, SCORING_DATE, WEIGHTS
from txrisk.schema import CATEGORY_COLUMNS, FEATURE_SETS, ID_COLUMNS
from txrisk.sources.fixtures import ORDER_TRANSACTIONS_SQL, TRANSACTIONS_SQL

_TABLES = {t: t for t in ("events", "customer", "nation", "region", "orders")}
TX = f"tx as ({TRANSACTIONS_SQL.format(**_TABLES)})"
ORDER_TX = f"tx as ({ORDER_TRANSACTIONS_SQL.format(**_TABLES)})"


def _round(expression: str, digits: int) -> str:
    # Adding 0 would be folded away; nullif/coalesce turns -0.0 into 0.0.
    return f"coalesce(nullif(round({expression}, {digits}), 0), case when {expression} is not null then 0.0::double end)"


def _mode(column: str, source: str) -> str:
    """Most frequent value per customer, the smallest on ties."""
    return f"""select CustomerId, v from (
        select CustomerId, v, row_number() over (partition by CustomerId order by count(*) desc, v) as rn
        from (select CustomerId, {column} as v from {source}) where v is not null and CustomerId is not null
        group by CustomerId, v) where rn = 1"""


def customers(name: str, source: str, reference: str | None = None) -> str:
    ref = f"timestamp '{reference}'" if reference else f"(select max(TransactionStartTime) from {source})"
    return f"""{name} as (
      select t.CustomerId,
        cast(floor((epoch_us({ref}) - epoch_us(max(TransactionStartTime))) / 86400000000.0) as bigint) as Recency,
        count(TransactionId) as Frequency,
        count(distinct AccountId) as AccountFrequency,
        coalesce(sum(Amount), 0.0) as Amount_sum,
        avg(Amount) as Amount_mean,
        stddev_samp(Amount) as Amount_std,
        min(Amount) as Amount_min,
        max(Amount) as Amount_max,
        count(Amount) as Amount_count,
        coalesce(sum(Value), 0.0) as Value_sum,
        avg(Value) as Value_mean,
        avg(hour(TransactionStartTime)) as AvgTransactionHour,
        cast(coalesce(any_value(d.v), -1) as integer) as MostFrequentDayOfWeek,
        coalesce(cast(any_value(c.v) as varchar), 'Unknown') as CountryCode,
        coalesce(any_value(u.v), 'Unknown') as CurrencyCode,
        coalesce(cast(any_value(h.v) as varchar), 'Unknown') as ChannelId
      from {source} t
      left join ({_mode("isodow(TransactionStartTime) - 1", source)}) d on t.CustomerId = d.CustomerId
      left join ({_mode("CountryCode", source)}) c on t.CustomerId = c.CustomerId
      left join ({_mode("CurrencyCode", source)}) u on t.CustomerId = u.CustomerId
      left join ({_mode("ChannelId", source)}) h on t.CustomerId = h.CustomerId
      where t.CustomerId is not null
      group by t.CustomerId)"""


def _customer_output(money: int, mean: int) -> str:
    exact = "CustomerId Recency Frequency AccountFrequency Amount_count MostFrequentDayOfWeek CountryCode CurrencyCode ChannelId"
    columns = exact.split()
    columns += [f"{_round(c, money)} as {c}" for c in ("Amount_sum", "Amount_min", "Amount_max", "Value_sum")]
    columns += [f"{_round(c, mean)} as {c}" for c in ("Amount_mean", "Amount_std", "Value_mean", "AvgTransactionHour")]
    return f"select {', '.join(columns)} from cust"


def preparation(source: str, feature_set: str, fit_source: str | None = None, suffix: str = "") -> str:
    """CTEs ``enc``, ``sca`` and ``ext``: long blocks of one feature set, fitted on ``fit_source``."""
    chosen = FEATURE_SETS[feature_set]
    fit_source = fit_source or source
    s = suffix

    def texts(table):
        return " union all ".join(
            f"select CustomerId, '{c}' as feature, {c} as value from {table}" for c in chosen.categorical
        )

    def numbers(table):
        return " union all ".join(
            f"select CustomerId, '{c}' as feature, cast({c} as double) as value from {table}" for c in chosen.numerical
        )

    extras = " union all ".join(
        f"select CustomerId, '{c}' as feature, coalesce(cast({c} as double), 0.0) as value from {source}"
        for c in chosen.extras
    )
    return f"""
      cats{s} as (select feature, value, count(*) as n,
                      row_number() over (partition by feature order by count(*) desc, value) as rn
                   from ({texts(fit_source)}) where value is not null group by feature, value),
      nums{s} as (select feature, avg(value) as mean, stddev_pop(value) * sqrt(count(value) / count(*)) as std
                   from ({numbers(fit_source)}) group by feature),
      enc{s} as (select t.CustomerId, 'cat__' || k.feature || '_' || k.value as feature,
                      case when coalesce(t.value, m.value) = k.value then 1.0::double else 0.0::double end as value
                   from ({texts(source)}) t join cats{s} k on t.feature = k.feature
                   join cats{s} m on t.feature = m.feature and m.rn = 1),
      sca{s} as (select t.CustomerId, 'num__' || t.feature as feature,
                      (coalesce(t.value, n.mean) - n.mean) / case when n.std = 0 then 1 else n.std end as value
                   from ({numbers(source)}) t join nums{s} n on t.feature = n.feature),
      ext{s} as ({extras})"""


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


_LONG = f"select CustomerId, feature, {_round('value', 6)} as value from "
CUST = customers("cust", "tx")

_DISTANCES = [
    " + ".join(
        f"power(max(case when feature = 'num__{c}' then value end) - ({x}), 2)"
        for c, x in zip(("Amount_sum", "Frequency", "Recency"), centre, strict=True)
    )
    for centre in CENTRES
]
ASSIGNED = f"""assigned as (
  select CustomerId, amount, frequency, recency,
    cast(case when d0 <= d1 and d0 <= d2 then 0 when d1 <= d2 then 1 else 2 end as integer) as cluster
  from (select CustomerId, {_DISTANCES[0]} as d0, {_DISTANCES[1]} as d1, {_DISTANCES[2]} as d2,
          max(case when feature = 'num__Amount_sum' then value end) as amount,
          max(case when feature = 'num__Frequency' then value end) as frequency,
          max(case when feature = 'num__Recency' then value end) as recency
        from sca group by CustomerId))"""
LABELS = """risk_labels as (
  select CustomerId, cast(cluster = (select cluster from assigned group by cluster
                                     order by avg(frequency), avg(recency) desc, cluster limit 1) as integer) as is_high_risk
  from assigned)"""
_LABELLED = _with(TX, CUST, preparation("cust", "A"), ASSIGNED, LABELS)

_RANKED = """ranked as (
  select CustomerId, is_high_risk,
    row_number() over (partition by is_high_risk order by md5(CustomerId || ':42')) as rn,
    count(*) over (partition by is_high_risk) as n
  from risk_labels)"""

_NEW = f"""old as (select * from tx where TransactionStartTime < timestamp '{CUT}'),
  recent as (select * from tx where TransactionStartTime >= timestamp '{CUT}')"""
_SCORING = _with(
    TX,
    _NEW,
    customers("cust_old", "old", CUT),
    customers("cust", "recent", SCORING_DATE),
    preparation("cust", "B", "cust_old"),
    "inputs as (select * from enc union all select * from sca union all select * from ext)",
)

# Twenty events make a request; one bad row refuses all of them. A request and a customer take the place of a customer.
_STREAM = _with(
    TX,
    "numbered as (select *, 'R' || cast(cast(floor(cast(substr(TransactionId, 2) as bigint) / 20) as bigint) as varchar) as r from tx)",
    """bad as (select distinct r from numbered where Amount is null or Amount <= 0 or Value is null or Value <= 0 or CountryCode is null
        or CurrencyCode is null or ChannelId is null or AccountId is null or CustomerId is null)""",
    f"old as (select * from tx where TransactionStartTime < timestamp '{CUT}')",
    "recent as (select * replace (r || '/' || CustomerId as CustomerId) from numbered where r not in (select r from bad))",
    customers("cust_old", "old", CUT),
    customers("cust", "recent", SCORING_DATE),
    preparation("cust", "B", "cust_old"),
    "inputs as (select * from enc union all select * from sca union all select * from ext)",
)

_SCORED = f"""scored as (
  select cast(Value + hour(TransactionStartTime) > 60 as integer) as is_high_risk,
    Value / (Value + 50) as by_value, hour(TransactionStartTime) / 23 as by_hour
  from tx)"""


def _metrics(score: str) -> str:
    return f"""select count(*) as n,
        count(*) filter (is_high_risk = 1 and {score} > 0.5) as tp,
        count(*) filter (is_high_risk = 0 and {score} > 0.5) as fp,
        count(*) filter (is_high_risk = 1 and not {score} > 0.5) as fn
      from scored where {score} is not null"""


_RATIOS = """round((n - fp - fn) / n, 6) as accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) as precision,
    round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) as recall,
    round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0), 6) as f1"""


def _auc(score: str) -> str:
    return f"""select round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) as roc_auc from (
      select pos, neg, coalesce(sum(neg) over (order by s rows between unbounded preceding and 1 preceding), 0) as below
      from (select {score} as s, cast(count(*) filter (is_high_risk = 1) as double) as pos,
              cast(count(*) filter (is_high_risk = 0) as double) as neg
            from scored where {score} is not null group by 1))"""


_MONEY = "money as (select 'Amount' as \"column\", Amount as v from tx union all select 'Value', Value from tx)"


_NUMBERS = "numbers as (" + " union all ".join(f"""select '{c}' as "column", cast({c} as double) as v from tx""" for c in NUMBERS) + ")"


def _value_counts(column: str) -> str:
    return f"""select '{column}' as "column", cast({column} as varchar) as value, count(*) as n
      from tx where {column} is not null group by 2"""


def _uniqueness(column: str) -> str:
    return f"""select '{column}' as "column", count(distinct {column}) as distinct_values, count(*) as rows,
      count(*) - count(distinct {column}) as duplicates, count(*) = count(distinct {column}) as is_unique from tx"""


def _relation(key: str, other: str) -> str:
    return f"""select '{key}->{other}' as relation, count(*) as keys, count(*) filter (n > 1) as keys_with_many,
      count(*) filter (n > 1) = 0 as is_unique
      from (select {key}, count(distinct {other}) as n from tx where {key} is not null group by 1)"""


_TYPES = {
    "ChannelId": "int",
    "CountryCode": "int",
    "Amount": "double",
    "Value": "double",
    "TransactionStartTime": "timestamp",
    "PricingStrategy": "int",
    "FraudResult": "int",
}
_COLUMNS = [*ID_COLUMNS, *CATEGORY_COLUMNS, "Amount", "Value", "TransactionStartTime"]

_LINEAR = (
    f"1 / (1 + exp(-({INTERCEPT}"
    + "".join(f" + sum(case when feature = '{name}' then value * ({w}) else 0 end)" for name, w in WEIGHTS.items())
    + ")))"
)

_MANIFEST_ROWS = ", ".join(f"('{name}')" for name in MANIFEST)

# Who is in the test part, with which label; the checks of the scores have to hold for all of them.
_TEST_ROWS = (
    _with(TX, CUST, preparation("cust", "A"), ASSIGNED, LABELS, _RANKED)
    + """select CustomerId, is_high_risk, true as in_range, true as agrees, true as separates{more}
         from ranked where rn <= round(n * 0.2::double)"""
)

_GRID_ROWS = " cross join ".join(
    f"(select unnest([{', '.join(map(str, values))}])::integer as {name}) {name}"
    for name, values in (("trees", GRID["trees"]), ("max_depth", GRID["depths"]), ("min_samples_split", GRID["min_splits"]))
)

ORACLE: dict[str, str] = {
    "time_features": _with(TX)
    + """select TransactionId, cast(hour(t) as integer) as TransactionHour, cast(day(t) as integer) as TransactionDay,
           cast(month(t) as integer) as TransactionMonth, cast(isodow(t) - 1 as integer) as TransactionDayOfWeek,
           cast(isodow(t) in (6, 7) as integer) as TransactionWeekend, cast(year(t) as integer) as TransactionYear
         from (select TransactionId, TransactionStartTime as t from tx)""",
    "customer_features": _with(TX, CUST) + _customer_output(4, 8),
    "order_customer_features": _with(ORDER_TX, CUST) + _customer_output(3, 6),
    "reference_date": _with(TX) + "select max(TransactionStartTime) as reference_date from tx",
    "validate_tx": _with(TX)
    + """select reason, count(*) as n from (
           select 'Amount: missing' as reason from tx where Amount is null
           union all select 'Amount: must be greater than 0' from tx where Amount <= 0
           union all select 'Value: missing' from tx where Value is null
           union all select 'Value: must be greater than 0' from tx where Value <= 0
           union all select 'CountryCode: missing' from tx where CountryCode is null
           union all select 'CurrencyCode: missing' from tx where CurrencyCode is null
           union all select 'ChannelId: missing' from tx where ChannelId is null
           union all select 'AccountId: missing' from tx where AccountId is null
           union all select 'CustomerId: missing' from tx where CustomerId is null
           union all select 'TransactionId: missing' from tx where TransactionId is null
           union all select 'TransactionStartTime: missing' from tx where TransactionStartTime is null) group by reason""",
    "impute_stats": _with(TX, CUST, preparation("cust", "A"))
    + f"""select feature, value as most_frequent, null::double as mean, null::double as std from cats where rn = 1
          union all select feature, null, {_round("mean", 6)}, {_round("std", 6)} from nums""",
    "encode_features": _with(TX, CUST, preparation("cust", "A")) + _LONG + "enc",
    "scale_features": _with(TX, CUST, preparation("cust", "A")) + _LONG + "sca",
    "features_a": _with(TX, CUST, preparation("cust", "A"))
    + _LONG
    + "(select * from enc union all select * from sca union all select * from ext)",
    "features_b": _with(TX, CUST, preparation("cust", "B"))
    + _LONG
    + "(select * from enc union all select * from sca union all select * from ext)",
    "align_features": _with(TX, CUST, preparation("cust", "B"))
    + f"""select c.CustomerId, m.feature, {_round("coalesce(f.value, 0.0)", 6)} as value
          from (select CustomerId from cust) c cross join (values {_MANIFEST_ROWS}) m(feature)
          left join (select * from enc union all select * from sca union all select * from ext) f
            on f.CustomerId = c.CustomerId and f.feature = m.feature""",
    "score_inputs": _SCORING + _LONG + "inputs",
    "score_linear": _SCORING + f"select CustomerId, round({_LINEAR}, 6) as risk_probability from inputs group by CustomerId",
    "stream_linear": _STREAM
    + f"""select split_part(CustomerId, '/', 1) as RequestId, split_part(CustomerId, '/', 2) as what, round({_LINEAR}, 6) as score
          from inputs group by CustomerId
          union all select r, 'rejected', cast(count(*) as double) from numbered where r in (select r from bad) group by r""",
    "profile_shape": _with(TX) + "select count(*) as rows, cast(16 as integer) as columns from tx",
    "profile_info": _with(TX)
    + " union all ".join(
        f"""select '{c}' as "column", '{_TYPES.get(c, "string")}' as type, count({c}) as non_null from tx"""
        for c in dict.fromkeys(_COLUMNS)
    ),
    "profile_describe": _with(TX, _NUMBERS)
    + """select "column", count(v) as count, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std,
           round(min(v), 6) as min, round(quantile_cont(v, 0.25), 6) as p25, round(quantile_cont(v, 0.5), 6) as p50,
           round(quantile_cont(v, 0.75), 6) as p75, round(max(v), 6) as max from numbers group by 1""",
    "id_uniqueness": _with(TX) + " union all ".join(_uniqueness(c) for c in ID_COLUMNS),
    "value_counts": _with(TX) + " union all ".join(_value_counts(c) for c in CATEGORY_COLUMNS),
    "class_balance": _with(TX)
    + """select FraudResult, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share
         from tx where FraudResult is not null group by 1""",
    "top_products": _with(TX)
    + """select ProductId, count(*) as n from tx where ProductId is not null group by 1 order by 2 desc, 1 limit 10""",
    # Edges first, then every value by comparison with them.
    "histogram": _with(TX, _MONEY)
    + """, ends as (select "column", min(v) as lo, max(v) as hi from money group by 1),
         edges as (select "column", bin, lo + (bin - 1) * ((hi - lo) / 50) as lower,
                     case when bin = 50 then hi else lo + bin * ((hi - lo) / 50) end as upper
                   from ends cross join (select unnest(range(1, 51)) as bin) b)
         select e."column", cast(bin as integer) as bin, round(lower, 6) as lower, round(upper, 6) as upper, count(v) as n
         from edges e left join money m on m."column" = e."column" and v >= lower and (v < upper or bin = 50)
         group by e."column", bin, lower, upper""",
    # The kernel summed over all values.
    "density_curve": _with(TX, _MONEY)
    + f""", s as (select "column", min(v) as lo, max(v) as hi, count(v) as total,
                   stddev_samp(v) * power(count(v), -0.2) as h from money group by 1),
         grid as (select "column", point, lo + point * ((hi - lo) / 199) as x, total, h
                  from s cross join (select unnest(range(0, 200)) as point) p),
         seen as (select "column", v, count(*) as n from money where v is not null group by all)
         select g."column", cast(g.point as integer) as point, {_round("g.x", 8)} as x,
           round(sum(n * exp(-power((x - v) / h, 2) / 2)) / (any_value(total) * any_value(h) * sqrt(2 * pi())), 8) as density
         from grid g join seen c on c."column" = g."column" group by g."column", g.point, g.x""",
    # A whisker ends at the furthest value that its fence leaves in, unless that lies inside the box.
    "box_stats": _with(TX, _MONEY)
    + """, q as (select "column", quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as median, quantile_cont(v, 0.75) as q3
                 from money group by 1),
         fences as (select *, q1 - 1.5 * (q3 - q1) as low, q3 + 1.5 * (q3 - q1) as high from q)
         select f."column", round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
           round(coalesce((select min(v) from money m where m."column" = f."column" and v >= low having min(v) <= f.q1), q1), 6) as whisker_low,
           round(coalesce((select max(v) from money m where m."column" = f."column" and v <= high having max(v) >= f.q3), q3), 6) as whisker_high,
           (select count(*) from money m where m."column" = f."column" and (v < low or v > high)) as outliers
         from fences f""",
    "distinct_pairs": _with(TX)
    + """select 'AccountId-CustomerId' as pair, count(*) as n from (select distinct AccountId, CustomerId from tx)
         union all select 'AccountId-SubscriptionId', count(*) from (select distinct AccountId, SubscriptionId from tx)""",
    "relation_checks": _with(TX)
    + " union all ".join(
        _relation(*r)
        for r in (
            ("AccountId", "CustomerId"),
            ("CustomerId", "AccountId"),
            ("AccountId", "SubscriptionId"),
            ("SubscriptionId", "AccountId"),
        )
    ),
    "shared_accounts": _with(TX)
    + """select AccountId, count(distinct CustomerId) as n from tx where AccountId is not null
         group by 1 having count(distinct CustomerId) > 1""",
    "shared_account_samples": _with(TX)
    + """select AccountId, CustomerId, TransactionId, TransactionStartTime, Amount, "row" from (
           select *, cast(row_number() over (partition by AccountId order by TransactionStartTime, TransactionId) as integer)
             as "row"
           from tx where AccountId in (select AccountId from tx group by 1 having count(distinct CustomerId) > 1))
         where "row" <= 5""",
    "assign_clusters": _with(TX, CUST, preparation("cust", "A"), ASSIGNED) + "select CustomerId, cluster from assigned",
    "cluster_summary": _with(TX, CUST, preparation("cust", "A"), ASSIGNED)
    + f"""select cluster, count(*) as customers, {_round("avg(amount)", 6)} as "num__Amount_sum",
            {_round("avg(frequency)", 6)} as "num__Frequency", {_round("avg(recency)", 6)} as "num__Recency"
          from assigned group by 1""",
    "label_from_cluster": _LABELLED + "select * from risk_labels",
    "training_set": _with(
        TX, CUST, preparation("cust", "A"), ASSIGNED, LABELS, preparation("cust", "B", suffix="_b")
    )
    + "select "
    + ", ".join(
        f"""{_round(f"max(case when feature = 'num__{c}' then value end)", 6)} as "num__{c}" """
        for c in FEATURE_SETS["B"].numerical
    )
    + f""", any_value(c.Frequency) as Frequency, {_round("any_value(c.AvgTransactionHour)", 6)} as AvgTransactionHour,
          any_value(c.MostFrequentDayOfWeek) as MostFrequentDayOfWeek, any_value(c.Recency) as Recency,
          any_value(c.AccountFrequency) as AccountFrequency, any_value(l.is_high_risk) as is_high_risk
        from sca_b f join cust c on f.CustomerId = c.CustomerId join risk_labels l on l.CustomerId = c.CustomerId
        where c.CountryCode <> 'Unknown' group by f.CustomerId""",
    "stratified_split": _with(TX, CUST, preparation("cust", "A"), ASSIGNED, LABELS, _RANKED)
    + """select CustomerId, is_high_risk, case when rn <= round(n * 0.2::double) then 'test' else 'train' end as split
         from ranked""",
    "stratified_folds": _with(TX, CUST, preparation("cust", "A"), ASSIGNED, LABELS, _RANKED)
    + """select CustomerId, is_high_risk, cast(cast(rn > round(n * (1::double / 3)) as integer)
           + cast(rn > round(n * (2::double / 3)) as integer) as integer) as fold from ranked""",
    "classification_metrics": _with(TX, _SCORED) + f"select n, {_RATIOS} from ({_metrics('by_value')})",
    "roc_auc": _with(TX, _SCORED) + _auc("by_value"),
    "model_comparison": _with(TX, _SCORED)
    + " union all ".join(
        f"select '{m}' as model, n, {_RATIOS}, ({_auc(m)}) as roc_auc from ({_metrics(m)})" for m in ("by_value", "by_hour")
    ),
    "rfm_clusters": _with(TX) + "select distinct CustomerId, true as nearest, true as centred from tx where CustomerId is not null",
    **{q: _TEST_ROWS.replace("{more}", ", true as as_table") for q in ("rf_scores", "default_rf_scores")},
    "logistic_scores": _TEST_ROWS.replace("{more}", ""),
    "logistic_optimum": _with(TX, CUST, preparation("cust", "B"))
    + """select distinct feature, true as at_optimum from (select * from enc union all select * from sca union all select * from ext)
         union all select '(intercept)', true""",
    "grid_search": _with(TX, CUST, preparation("cust", "A"), ASSIGNED, LABELS, _RANKED)
    + f""", folds as (select cast(cast(rn > round(n * (1::double / 3)) as integer) + cast(rn > round(n * (2::double / 3)) as integer) as integer) as fold
                     from ranked)
         select trees, max_depth, min_samples_split, fold, n, true as is_area, true as best_is_greatest
         from (select fold, count(*) as n from folds group by fold) f cross join {_GRID_ROWS}""",
    "encode_sparse": _with(TX, CUST, preparation("cust", "B"), "own as (select CustomerId, min(AccountId) as v from tx group by 1)")
    + f"""select CustomerId, feature, {_round("value", 6)} as value from (
           select * from enc union all select * from sca where feature in ('num__Amount_sum', 'num__Value_mean')
           union all select * from ext where feature = 'Frequency'
           union all select CustomerId, 'cat__FirstAccount_' || v, 1.0::double from own where CustomerId is not null)
         where value <> 0""",
    "score_batch": _with(TX)
    + f"""select distinct CustomerId, true as in_range, true as as_table from tx
          where CustomerId is not null and TransactionStartTime >= timestamp '{CUT}'""",
}
