"""Derived datasets: tables that SQL makes of other datasets, as views or as written tables, with SQL functions of their own."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import SparkSession

from chainframe.plans import gate


class Function(NamedTuple):
    """A user function: a SQL expression over x0, x1, ... of the types given."""

    source: str
    input_types: Iterable[str]
    output_type: str


class Refused(ValueError):
    """What is wrong with a dataset, by table."""

    def __init__(self, codes: dict[str, str]):
        super().__init__(", ".join(f"{name}: {code}" for name, code in sorted(codes.items())))
        self.codes = codes


def define(spark: SparkSession, dataset: str, functions: Mapping[str, Function]) -> None:
    """Makes the functions of a dataset, called as dataset.name in SQL. Spark puts their expressions into the plan that calls them."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{dataset}`")
    for name, f in functions.items():
        parameters = ", ".join(f"x{i} {kind}" for i, kind in enumerate(f.input_types))
        spark.sql(f"CREATE OR REPLACE FUNCTION `{dataset}`.`{name}`({parameters}) RETURNS {f.output_type} RETURN {f.source}")


def deploy(spark: SparkSession, dataset: str, tables: Mapping[str, str], functions: Mapping[str, Function] | None = None, known: Mapping[str, Iterable[str]] | None = None, written: bool = False) -> None:
    """Makes the tables of a dataset from their SQL, after the checks of the gate: views, or tables with what the SQL gives now.

    known: tables of other datasets, by the name that the SQL gives these; by default names are not looked up. Nothing is made if one table is refused.
    """
    functions = functions or {}
    define(spark, dataset, functions)
    wrong = {name: code for name, code in gate.check_all(spark, tables, functions, known).items() if code}
    if wrong:
        raise Refused(wrong)
    for name, sql in tables.items():
        if written:
            spark.sql(f"DROP TABLE IF EXISTS `{dataset}`.`{name}`")
            spark.sql(f"CREATE TABLE `{dataset}`.`{name}` USING parquet AS {sql}")
        else:
            spark.sql(f"CREATE OR REPLACE VIEW `{dataset}`.`{name}` AS {sql}")
