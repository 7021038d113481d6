"""Gates: checks a month must pass before it is published, and expectations on the models."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.fixed_values import DUE_HOURS, FRESH_ERROR_DAYS, FRESH_WARN_DAYS, LOAD_CHECKS, OVERDUE_DAY_OF_MONTH, SOURCE_TABLES
from tallywatch.functions.columns import month_key


def orphan_hashes(tr: DataFrame, tx: DataFrame) -> DataFrame:
    """Transactions named by transfers but absent from their month. Hashes are distinct before the join."""
    named = tr.where("transaction_hash is not null").select(month_key(F.col("date")).alias("month"), "transaction_hash").distinct()
    there = tx.select(month_key(F.col("date")).alias("month"), F.col("hash").alias("transaction_hash"))
    return named.join(there, ["month", "transaction_hash"], "left_anti")


def orphan_blocks(tr: DataFrame, bl: DataFrame) -> DataFrame:
    """Block numbers named by transfers but absent from their month, with the rows that name them."""
    first_day = F.trunc("date", "month").alias("first_day")
    named = tr.where("block_number is not null").groupBy(first_day, "block_number").agg(F.count(F.lit(1)).alias("rows"))
    there = bl.select(first_day, F.col("number").alias("block_number"))
    return named.join(there, ["first_day", "block_number"], "left_anti").select(month_key(F.col("first_day")).alias("month"), "block_number", "rows")


def check_orphans(tr: DataFrame, tx: DataFrame, bl: DataFrame) -> DataFrame:
    """Per month: distinct missing transactions, rows of missing blocks, and the null keys no join can judge."""
    months = tr.groupBy(month_key(F.col("date")).alias("month")).agg(
        F.expr("count_if(transaction_hash is null or block_number is null) as null_keys"))
    hashes = orphan_hashes(tr, tx).groupBy("month").agg(F.count(F.lit(1)).alias("missing_transactions"))
    blocks = orphan_blocks(tr, bl).groupBy("month").agg(F.sum("rows").alias("rows_without_block"))
    return (months.join(hashes, "month", "left").join(blocks, "month", "left")
            .fillna(0, ["missing_transactions", "rows_without_block"]))


def gate_months(tr: DataFrame, tx: DataFrame, bl: DataFrame) -> DataFrame:
    """The seven load checks of every month: result, expected, passed.

    Transfers are read once per key: days, hashes and block numbers. Repeats are folded per hash before the hash is
    looked up, so a hash with very many transfers is one row by then.
    """
    month = month_key(F.col("date")).alias("month")
    days = (tr.select("date").distinct().groupBy(month)
            .agg(F.count("date").alias("r0"), F.max(F.expr("day(last_day(date))")).cast("long").alias("expected0")))
    first_day = F.trunc("date", "month").alias("first_day")   # stands for the month in the large shuffles: shorter, and no text per row
    per_key = tr.groupBy(first_day, "transaction_hash", "log_index").agg(
        F.count(F.lit(1)).alias("n"), F.expr("count_if(amount is null or from_address is null or to_address is null) as bad"))
    # Both sides are folded per hash in one aggregation, so neither is sorted for a join.
    named = per_key.select("first_day", "transaction_hash", F.expr("n - 1 as again"), "bad", F.lit(True).alias("named"), F.lit(None).cast("boolean").alias("there"))
    there = tx.select(first_day, F.col("hash").alias("transaction_hash"), F.lit(0).cast("long").alias("again"), F.lit(0).cast("long").alias("bad"),
                      F.lit(None).cast("boolean").alias("named"), F.lit(True).alias("there"))
    per_hash = named.unionByName(there).groupBy("first_day", "transaction_hash").agg(
        F.sum("again").alias("again"), F.sum("bad").alias("bad"), F.max("named").alias("named"), F.max("there").alias("there"))
    hashes = per_hash.groupBy(month_key(F.col("first_day")).alias("month")).agg(
        F.sum("again").alias("r1"), F.sum("bad").alias("r2"), F.expr("count_if(named and there is null and transaction_hash is not null) as r3"))
    blocks = orphan_blocks(tr, bl).groupBy("month").agg(F.sum("rows").alias("r4"))
    numbers = (bl.groupBy(month, "number").agg(F.count(F.lit(1)).alias("n")).groupBy("month")
               .agg(F.expr("max(number) - min(number) + 1 - count(number) as r5"), F.expr("sum(n) - count(number) as r6")))
    wide = days.join(hashes, "month", "left").join(blocks, "month", "left").fillna(0, ["r4"]).join(numbers, "month", "full")
    cells = F.array(*[F.struct(F.lit(i).alias("nr"), F.lit(label).alias("check"), F.col(f"r{i}").alias("result"),
                               (F.col("expected0") if i == 0 else F.lit(0).cast("long")).alias("expected"))
                      for i, label in enumerate(LOAD_CHECKS)])
    return (wide.select("month", F.explode(cells).alias("c")).select("month", "c.*")
            .withColumn("passed", F.coalesce(F.col("result") == F.col("expected"), F.lit(False))))


def gate_failed(gates: DataFrame, months: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Why each month may not be published; no row for a month that may. A month without checks is refused too."""
    failed = gates.where(~F.col("passed")).select("month", F.expr(
        "concat(check, ' = ', coalesce(cast(result as string), 'null'), ' (expected ', coalesce(cast(expected as string), 'null'), ')') as problem"))
    silent = months.join(gates.select("month").distinct(), "month", "left_anti").select("month", F.lit("no checks ran").alias("problem"))
    out = failed.unionByName(silent)
    if errors is not None:
        out = out.unionByName(errors.select("month", F.concat(F.lit("error: "), "error").alias("problem")))
    return out.groupBy("month").agg(F.array_sort(F.collect_list("problem")).alias("problems"))


def require_passed(gates: DataFrame, months: DataFrame) -> None:
    """Refuse to publish: raises with all months that failed (a row per month of the history; `gate_failed` is the table)."""
    refused = gate_failed(gates, months).orderBy("month").collect()
    if refused:
        raise ValueError(f"refusing to publish {len(refused)} months: " + "; ".join(f"{r.month}: {', '.join(r.problems)}" for r in refused))


# Expectations: the data tests on staging and marts

def table_tests(df: DataFrame, table: str, not_null: list[str] = (), accepted: dict[str, list] | None = None) -> DataFrame:
    """The null and value tests of one table in one pass: rows are folded by the tested columns' values, and those few groups
    give all results."""
    accepted = accepted or {}
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null]
    folded = df.groupBy(*accepted).agg(*(nulls or [F.count(F.lit(1)).alias("rows")]))
    names = {f"not_null_{table}_{c}": F.coalesce(F.sum(f"null_{c}"), F.lit(0)) for c in not_null}
    names |= {f"accepted_values_{table}_{c}": F.count_distinct(F.when(~F.col(c).isin(values), F.col(c))) for c, values in accepted.items()}
    wide = folded.agg(*[value.cast("long").alias(name) for name, value in names.items()])
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("test"), F.col(n).alias("failures")) for n in names])).alias("c")
    return wide.select(cells).select("c.test", "c.failures", (F.col("c.failures") == 0).alias("passed"))


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    again = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _result(again.agg(F.count(F.lit(1)).alias("failures")), f"unique_{table}_{column}")


def _result(counted: DataFrame, name: str) -> DataFrame:
    return counted.select(F.lit(name).alias("test"), F.col("failures").cast("long"), (F.col("failures") == 0).alias("passed"))


def reconcile(payments: DataFrame, tr: DataFrame) -> DataFrame:
    """Days on which the cube's transfers differ from the raw rows, a day missing on either side included."""
    cube = payments.groupBy("date").agg(F.sum("transfers").alias("cube_transfers"))
    raw = tr.groupBy("date").agg(F.count(F.lit(1)).alias("raw_transfers"))
    return cube.join(raw, "date", "full").where(~F.col("cube_transfers").eqNullSafe(F.col("raw_transfers")))


def expectations(models: dict[str, DataFrame], tokens: list[str]) -> DataFrame:
    """The 21 data tests as one table. `models` holds the four staging frames and the three marts by short name."""
    bands = ["under 10", "10 to 1k", "1k to 100k", "100k and over"]
    m = models
    tests = [
        table_tests(m["transfers"], "stg_transfers", ["transaction_hash", "amount"], {"token": tokens}),
        table_tests(m["transactions"], "stg_transactions", ["hash"]), unique(m["transactions"], "stg_transactions", "hash"),
        table_tests(m["blocks"], "stg_blocks", ["block_number"]), unique(m["blocks"], "stg_blocks", "block_number"),
        table_tests(m["load"], "stg_load", accepted={"source_table": list(SOURCE_TABLES)}),
        table_tests(m["payments"], "payments", ["cube_key", "transfers"],
                    {"token": tokens, "amount_band": bands, "route": ["direct", "via contract"]}),
        unique(m["payments"], "payments", "cube_key"),
        table_tests(m["health"], "health", ["health_key"]), unique(m["health"], "health", "health_key"),
        table_tests(m["pipeline"], "daily", ["date"], {"missing_blocks": [0], "duplicate_blocks": [0]}), unique(m["pipeline"], "daily", "date"),
        _result(reconcile(m["payments"], m["transfers"]).agg(F.count(F.lit(1)).alias("failures")), "payments_reconcile"),
    ]
    return reduce(DataFrame.unionByName, tests)


def freshness(df: DataFrame, column: str, as_of: Column, warn_days: int = FRESH_WARN_DAYS, error_days: int = FRESH_ERROR_DAYS) -> DataFrame:
    """Age of the newest load at `as_of`, and whether it passes."""
    age = (as_of.cast("timestamp").cast("long") - F.col("newest").cast("timestamp").cast("long")) / 86400.0
    return (df.agg(F.max(column).alias("newest")).select("newest", age.cast("double").alias("age_days"))
            .withColumn("status", F.expr(f"case when age_days > {error_days} or newest is null then 'error' "
                                         f"when age_days > {warn_days} then 'warn' else 'pass' end")))


# Which months are complete, due and worth loading

def month_calendar(months: DataFrame) -> DataFrame:
    """`months` has `month` as 'YYYY-MM': one row per day."""
    first = F.to_date(F.concat("month", F.lit("-01")))
    return months.select("month", F.explode(F.sequence(first, F.last_day(first))).alias("date"))


def missing_days(listing: DataFrame, months: DataFrame) -> DataFrame:
    """Days of the months with no file, per source table."""
    tables = F.explode(F.array(*map(F.lit, SOURCE_TABLES))).alias("source_table")
    return (month_calendar(months).select("month", "date", tables)
            .join(listing.select("source_table", "date"), ["source_table", "date"], "left_anti"))


def load_plan(months: DataFrame, loaded: DataFrame, missing: DataFrame, now: str, force: bool = False) -> DataFrame:
    """Load a month once, when every day of every table is there. Overdue after the tenth of the next month."""
    gaps = (missing.groupBy("month", "source_table").agg(F.array_sort(F.collect_list(F.col("date").cast("string"))).alias("d"))
            .withColumn("line", F.expr("concat(source_table, ': ', array_join(slice(d, 1, 5), ', '), if(size(d) > 5, ' and more', ''))"))
            .withColumn("nr", F.expr("case source_table when 'token_transfers' then 0 when 'transactions' then 1 else 2 end"))
            .groupBy("month").agg(F.array_sort(F.collect_list(F.struct("nr", "line", "source_table", "d"))).alias("g"))
            .select("month", F.expr("array_join(transform(g, x -> x.line), '; ') as gaps"),
                    F.expr("flatten(transform(g, x -> transform(x.d, y -> concat(x.source_table, ' ', y)))) as missing")))
    end = "add_months(to_date(concat(month, '-01')), 1)"
    out = (months.join(loaded.select("month", F.lit(True).alias("is_loaded")), "month", "left").join(gaps, "month", "left")
           .withColumn("is_loaded", F.coalesce("is_loaded", F.lit(False)))
           .withColumn("now", F.lit(now).cast("timestamp_ntz"))
           .withColumn("due", F.expr(f"cast({end} as timestamp_ntz) + interval {DUE_HOURS} hours"))
           .withColumn("overdue_at", F.expr(f"cast(date_add({end}, {OVERDUE_DAY_OF_MONTH - 1}) as timestamp_ntz)")))
    state = F.expr(f"case when is_loaded and not {str(force).lower()} then 'loaded' when now < due then 'early' "
                   "when gaps is not null then 'incomplete' else 'load' end")
    return out.withColumn("state", state).select(
        "month", (F.col("state") == "load").alias("load"),
        ((F.col("state") == "incomplete") & (F.col("now") >= F.col("overdue_at"))).alias("overdue"),
        F.expr("""case state when 'loaded' then concat(month, ' is already loaded.')
                  when 'early' then concat(month, ' is not due yet: the source needs until ', date_format(cast(due as timestamp), 'yyyy-MM-dd HH:mm'), ' UTC.')
                  when 'incomplete' then concat(month, ' is not complete in the source yet (', gaps, ').')
                  else concat(month, ' is complete in the source: loading it', if(is_loaded, ' again', ''), '.') end as reason"""), F.array_join(F.coalesce("missing", F.array()), ", ").alias("missing"))


# Reports over the published tables

def backfill_summary(months: DataFrame, tr: DataFrame, tx: DataFrame, bl: DataFrame, gates: DataFrame) -> DataFrame:
    """Rows and checks per month, months without results included, and a grand total."""
    def per_month(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(month_key(F.col("date")).alias("month")).agg(F.count(F.lit(1)).alias(name))

    checks = gates.groupBy("month").agg(F.expr("count_if(passed) as checks_passed"), F.count(F.lit(1)).alias("checks"))
    rows = (months.join(per_month(tr, "transfers"), "month", "left").join(per_month(tx, "transactions"), "month", "left")
            .join(per_month(bl, "blocks"), "month", "left").join(checks, "month", "left"))
    sums = [F.sum(c).alias(c) for c in ("transfers", "transactions", "blocks", "checks_passed", "checks")]
    return rows.rollup("month").agg(*sums).select(F.coalesce("month", F.lit("Total")).alias("month"), *[
        c for c in ("transfers", "transactions", "blocks", "checks_passed", "checks")])


def month_report(months: DataFrame, gates: DataFrame, rules: DataFrame, eps: DataFrame, flagged: DataFrame) -> DataFrame:
    """Per month: checks passed, rules broken, episodes that touch it, days the pipeline flags."""
    checks = gates.groupBy("month").agg(F.expr("count_if(passed) as checks_passed"), F.count(F.lit(1)).alias("checks"))
    broken = (rules.groupBy("month", "check").agg(F.sum("violations").alias("v")).groupBy("month")
              .agg(F.count(F.lit(1)).alias("rules"), F.expr("count_if(v > 0) as rules_broken"), F.sum("v").alias("rows_breaking")))
    touched = eps.select("investigated", F.explode(F.expr("sequence(trunc(start, 'month'), trunc(end, 'month'), interval 1 month)")).alias("m"))
    touched = touched.groupBy(month_key(F.col("m")).alias("month")).agg(
        F.count(F.lit(1)).alias("episodes"), F.expr("count_if(investigated) as investigated"))
    bad = flagged.groupBy(month_key(F.col("date")).alias("month")).agg(F.count(F.lit(1)).alias("flagged_days"))
    out = months
    for part in (checks, broken, touched, bad):
        out = out.join(part, "month", "left")
    return out.fillna(0, ["episodes", "investigated", "flagged_days"])
