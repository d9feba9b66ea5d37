import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from txrisk.operators import quantiles
from txrisk.operators.quantiles import exact_quantiles, ordered_bits

RNG = np.random.default_rng(11)
SHAPES = {
    "tiny": RNG.random(4000) * 1e-9,
    "clustered": 1e6 + RNG.integers(0, 50, 4000) * 2.0**-30,
    "log_spread": RNG.choice([-1, 1], 4000) * 10.0 ** RNG.uniform(-300, 300, 4000),
    "subnormal": RNG.integers(0, 10**6, 4000) * 5e-324,
    "few": RNG.choice([0.0, -0.0, 1.5], 4000),
    "money": np.round(RNG.exponential(90, 4000), 2),
}
SHARES = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.999, 1.0]


@pytest.fixture(scope="module")
def shapes(spark):
    rows = [tuple(float(v) for v in row) for row in zip(*SHAPES.values(), strict=True)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in SHAPES)).repartition(6)


def test_bits_are_those_of_the_double(spark):
    values = [0.0, 5e-324, 2.0**-1022, 2.0**-1023, 1.0, 1.5, 2.0, 1 - 2.0**-53, 1 + 2.0**-52, 1e308, 1.7976931348623157e308, float("inf"), 3.141592653589793, 1e-310]
    values += [float(2.0**k) for k in range(-1074, 1024, 7)] + [float(np.nextafter(2.0**k, 0)) for k in range(-1021, 1024, 13)]
    values += [-v for v in values]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_bits(F.col("v") + 0.0).alias("bits")).collect()
    for v, bits in rows:
        own = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert bits == (own if v >= 0 else -own), v


def test_values_of_any_spread(shapes):
    found = exact_quantiles(shapes, list(SHAPES), SHARES)
    for c, values in SHAPES.items():
        ordered = np.sort(values)
        at = np.array(SHARES) * (len(ordered) - 1)
        low, high = ordered[np.floor(at).astype(int)], ordered[np.ceil(at).astype(int)]
        assert found[c] == [a if a == b else a + (b - a) * (x - np.floor(x)) for a, b, x in zip(low, high, at, strict=True)], c


def test_no_step_holds_more_than_its_cells(shapes, monkeypatch):
    """Clustered, tiny and widely spread values all end within four steps of at most 65,536 cells for each open prefix."""
    steps = []
    plain = quantiles._counts

    def counted(long, shift):
        out = plain(long, shift)
        steps.append((shift, out.groupBy("column", F.shiftright("prefix", 16).alias("p")).count().agg(F.max("count")).first()[0]))
        return out

    monkeypatch.setattr(quantiles, "_counts", counted)
    exact_quantiles(shapes, list(SHAPES), SHARES)
    assert [s for s, _ in steps] == [48, 32, 16, 0] and all(n <= 65_536 for _, n in steps)
    steps.clear()
    exact_quantiles(shapes, ["money"], [0.25, 0.5, 0.75])
    assert [s for s, _ in steps] == [48, 32]
