"""Intermediate tables have an owner: they end with it, with their last reader, and with an error."""

import os

import pytest
from pyspark.sql import functions as F

from txrisk.plans.training import train_risk_model
from txrisk.session import Scratch, materialise, release, retain


def tables(spark):
    return {name for name in os.listdir(spark.conf.get("spark.checkpoint.dir")) if name.startswith("txrisk-")}


def test_tables_end_with_their_owner(spark):
    before = tables(spark)
    with Scratch() as own:
        first = own.keep(spark.range(5))
        second = own.keep(first.where("id > 1"))
        assert len(tables(spark) - before) == 2 and second.count() == 3
    assert tables(spark) == before


def test_tables_end_after_an_error(spark):
    before = tables(spark)
    with pytest.raises(ZeroDivisionError), Scratch() as own:
        own.keep(spark.range(5))
        raise ZeroDivisionError
    assert tables(spark) == before
    with pytest.raises(Exception, match="no such row"), Scratch() as own:
        own.keep(spark.range(5))
        own.keep(spark.range(5).select(F.raise_error(F.lit("no such row")).cast("int").alias("x")))
    assert tables(spark) == before


def test_the_last_reader_ends_a_table(spark):
    before = tables(spark)
    with Scratch() as own:
        kept = retain(own.keep(spark.range(7)))
    assert kept.count() == 7
    release(kept)
    assert tables(spark) == before
    release(kept)  # nothing is left to release
    release(spark.range(1))
    one = materialise(spark.range(3))
    two = retain(one)
    release(two)
    assert one.count() == 3
    release(one)
    assert tables(spark) == before


def test_training_leaves_only_its_scored_rows(spark, many_tx):
    before = tables(spark)
    with pytest.raises(AttributeError):
        train_risk_model(many_tx, estimator=object())
    failed = tables(spark)
    run = train_risk_model(many_tx)
    assert run.test_scores.count() and failed == before
    assert len(tables(spark) - before) == 1
    release(run.test_scores)
    assert tables(spark) == before
