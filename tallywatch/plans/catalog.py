"""Every query by name: the Spark form, and the SQL it must agree with."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.plans.oracle_base import compose
from tallywatch.session import pin_utc
from tallywatch.sources.adapters import Raw

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _rounds(spec: str) -> dict[str, int]:
    """'volume:2 rate' -> {'volume': 2, 'rate': 6}."""
    return {c.partition(":")[0]: int(c.partition(":")[2] or 6) for c in spec.split()}


def query(name: str, sql: str | None = None, rounds: str = ""):
    """Register a function of Raw. `rounds` names the doubles both sides round before they are compared."""
    digits = _rounds(rounds)

    def register(build: Callable[[Raw], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = build(Raw(pin_utc(spark), sf_dir))
            return out.withColumns({c: F.round(F.col(c), d) + 0.0 for c, d in digits.items()}) if digits else out

        QUERIES[name] = run
        if sql is not None:
            body = sql
            if digits:
                replaced = ", ".join(f'round("{c}", {d}) + 0.0 as "{c}"' for c, d in digits.items())
                body = f"select * replace ({replaced}) from ({sql})"
            ORACLES[name] = compose(body)
        return build

    return register
