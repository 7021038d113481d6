"""Watching the source: what each table-day looks like at each visit, and what changed between visits."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.fixed_values import DUE_HOURS, ENTITY_ADDRESSES, LATE_HOURS, PUBLISHED_MEASURES, SNAPSHOT_MEASURES, UNIT_SCALE
from tallywatch.functions.columns import beside, entity_of
from tallywatch.functions.positions import with_position

KEY = ["source_table", "date"]
TIMES = ("first_written", "last_written")
ENTITY_MEASURES = ("stable_rows", "stable_amount", "stable_failed")


def _measured(name: str, df: DataFrame, entities: dict[str, str], light: bool) -> DataFrame:
    """The columns measured, the same for every source table. `light` leaves entity columns unread."""
    block = "number" if name == "blocks" else "block_number"
    written = F.col("last_modified") if "last_modified" in df.columns else F.lit(None).cast("timestamp_ntz")
    none = F.lit(None)
    ours, value, failed = none.cast("int"), none.cast("double"), none.cast("int")
    if not light and name == "token_transfers":
        ours = entity_of(F.col("token_address"), entities).isNotNull().cast("int")
        value = F.when(ours == 1, F.col("value")).cast("double")
    if not light and name == "transactions":
        ours = entity_of(F.col("to_address"), entities).isNotNull().cast("int")
        failed = ((ours == 1) & (F.col("receipt_status") == 0)).cast("int")
    return df.select(F.lit(name).alias("source_table"), "date", "file_name", F.col(block).alias("block"), written.alias("written"),
                     ours.alias("ours"), value.alias("value"), failed.alias("failed"))


def snapshot(sources: dict[str, DataFrame], days: DataFrame, taken_at: str, light: bool = False,
             entities: dict[str, str] | None = None) -> DataFrame:
    """Every source table on every listed day in one aggregation; a day that is not there has rows = 0.

    Sources carry `file_name` from the scan. File names are collected per day: as many as the day has files.
    """
    rows = reduce(DataFrame.unionByName, [_measured(n, df, entities or ENTITY_ADDRESSES, light) for n, df in sources.items()])
    names = F.collect_set("file_name")
    found = rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("rows"), F.size(names).cast("long").alias("files"),
        F.md5(F.array_join(F.array_sort(names), ",")).alias("file_names"), F.min("block").alias("min_block"),
        F.max("block").alias("max_block"), F.min("written").alias("first_written"), F.max("written").alias("last_written"),
        F.sum("ours").cast("long").alias("stable_rows"), (F.sum("value") / UNIT_SCALE).alias("stable_amount"),
        F.sum("failed").cast("long").alias("stable_failed"))
    wanted = days.select("date", F.explode(F.array(*[F.lit(n) for n in sources])).alias("source_table"))
    return (wanted.join(found, KEY, "left").fillna(0, ["rows", "files"])
            .select(F.lit(taken_at).cast("timestamp_ntz").alias("taken_at"), *KEY, *SNAPSHOT_MEASURES))


def combine(snaps: list[DataFrame]) -> DataFrame:
    """Snapshots merged by name: older ones may lack later measures."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), snaps).orderBy("taken_at", *KEY)


def _differs(old: str, new: str, column: str) -> str:
    if column == "stable_amount":
        return f"not coalesce(abs({old} - {new}) <= 1e-6 * greatest(1.0D, abs({old})), {old} is null and {new} is null)"
    return f"not ({old} <=> {new})"


def _change(old: str, new: str, column: str) -> str:
    """'rows 10 → 12': the words for one changed measure."""
    name = column.replace("_", " ")

    def show(x: str) -> str:
        if column in TIMES:
            return f"date_format(cast({x} as timestamp), 'yyyy-MM-dd HH:mm')"
        return f"format_number({x}, {2 if column == 'stable_amount' else 0})"

    if column == "file_names":
        return "'different file names'"
    return f"concat('{name} ', coalesce({show(old)}, '–'), ' → ', coalesce({show(new)}, '–'))"


def _changes(old: str, new: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        a, b = old.format(c), new.format(c)
        both = f" and {a} is not null and {b} is not null" if c in ENTITY_MEASURES else ""
        parts.append(f"if({_differs(a, b, c)}{both}, {_change(a, b, c)}, null)")
    return f"array_compact(array({', '.join(parts)}))"


def _event(df: DataFrame, kind: str, seen_at: str, detail: str, hours: str = "cast(null as double)") -> DataFrame:
    return df.selectExpr(f"'{kind}' as kind", *KEY, f"{seen_at} as seen_at", f"{detail} as detail", f"{hours} as hours_after_day")


def _hours_after(day: str, moment: str) -> str:
    seconds = "cast(cast({} as timestamp) as bigint)"
    return f"({seconds.format(moment)} - {seconds.format(f'cast(date_add({day}, 1) as timestamp_ntz)')}) / 3600.0D"


def late(snaps: DataFrame, now: str) -> DataFrame:
    """Table-days never seen although they are due."""
    days = snaps.groupBy(*KEY).agg(F.max("rows").alias("most"), F.max("taken_at").alias("seen_at"))
    due = days.where("most = 0").where(f"{_hours_after('date', f"timestamp_ntz'{now}'")} > {DUE_HOURS}")
    return _event(due, "late", "seen_at", f"'not in the source more than {DUE_HOURS} hours after the day ended'")


def arrived(snaps: DataFrame) -> DataFrame:
    first = (snaps.where("rows > 0").groupBy(*KEY)
             .agg(F.expr("min_by(struct(taken_at, first_written), taken_at) as s")).where("s.first_written is not null")
             .selectExpr(*KEY, "s.taken_at as taken_at", f"{_hours_after('date', 's.first_written')} as h"))
    return _event(first, "arrived", "taken_at",
                  f"concat('first written ', format_string('%.1f', h), ' hours after the day ended', if(h > {LATE_HOURS}, ' (late)', ''))", "h")


def changed(snaps: DataFrame) -> DataFrame:
    """Consecutive visits to a table-day that differ. The window holds the visits to one table-day."""
    w = Window.partitionBy(*KEY).orderBy("taken_at")
    pairs = (snaps.withColumn("prev", F.lag(F.struct(*SNAPSHOT_MEASURES)).over(w)).where("prev.rows > 0")
             .withColumn("diffs", F.expr(_changes("prev.{}", "{}", SNAPSHOT_MEASURES))).where("size(diffs) > 0"))
    return _event(pairs, "changed", "taken_at", "array_join(diffs, '; ')")


def latest_snapshot(snaps: DataFrame) -> DataFrame:
    columns = [c for c in snaps.columns if c not in KEY]
    return snaps.groupBy(*KEY).agg(F.max_by(F.struct(*columns), "taken_at").alias("s")).select(*KEY, *[f"s.{c}" for c in columns])


def republished(snaps: DataFrame, manifest: DataFrame) -> DataFrame:
    """Published table-days whose latest visit no longer matches what was loaded."""
    loaded = manifest.select(*KEY, *[F.col(c).alias(f"was_{c}") for c in PUBLISHED_MEASURES])
    both = (loaded.join(latest_snapshot(snaps), KEY)
            .withColumn("diffs", F.expr(f"if(rows = 0, array(concat('no longer in the source (it had ', format_number(was_rows, 0), ' rows)')), "
                                        f"{_changes('was_{}', '{}', PUBLISHED_MEASURES)})")).where("size(diffs) > 0"))
    return _event(both, "republished", "taken_at", "concat('since this project loaded it: ', array_join(diffs, '; '))")


def source_events(snaps: DataFrame, manifest: DataFrame | None, now: str) -> DataFrame:
    """Every delay, arrival and change the snapshots show, oldest first."""
    parts = [late(snaps, now), arrived(snaps), changed(snaps)]
    if manifest is not None:
        parts.append(republished(snaps, manifest))
    out = reduce(DataFrame.unionByName, parts)
    return (out.withColumn("event_id", F.concat_ws("|", "kind", "source_table", F.date_format("date", "yyyy-MM-dd"), "detail"))
            .orderBy("seen_at", "date", "source_table"))


def new_events(events: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Events worth telling about that were not there last time."""
    told = events.where(F.col("kind").isin("late", "changed", "republished"))
    return told if previous is None else told.join(previous.select("event_id"), "event_id", "left_anti")


def event_listing(events: DataFrame, kinds: tuple[str, ...] = ("late", "changed", "republished")) -> DataFrame:
    rank = F.expr("case kind when 'republished' then 0 when 'changed' then 1 else 2 end")
    chosen = events.where(F.col("kind").isin(*kinds))
    return with_position(chosen, rank, F.col("seen_at").desc(), F.col("date").desc(), "source_table").orderBy("position")


def source_status(snaps: DataFrame, manifest: DataFrame, events: DataFrame) -> DataFrame:
    """One row that shows a zero is a comparison and not an empty join."""
    seen = snaps.groupBy("taken_at").agg(F.lit(1).alias("one")).agg(
        F.min("taken_at").alias("first_taken"), F.max("taken_at").alias("last_taken"), F.count(F.lit(1)).alias("snapshots"))
    published = manifest.agg(F.count(F.lit(1)).alias("published_table_days"), F.count_distinct("date").alias("published_days"))
    compared = manifest.select(*KEY).join(latest_snapshot(snaps).select(*KEY, "taken_at"), KEY).agg(
        F.count(F.lit(1)).alias("compared_table_days"), F.min("taken_at").alias("rechecked_by"))
    late_in = f"kind = 'arrived' and hours_after_day > {LATE_HOURS}"
    per_day = events.groupBy("date", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"count_if({late_in})").alias("late_in"))
    counts = per_day.agg(*[F.expr(e) for e in (
        "coalesce(sum(n) filter (where kind = 'republished'), 0) as republished_table_days",
        "count_if(kind = 'republished') as republished_days",
        "coalesce(sum(n) filter (where kind = 'arrived'), 0) as arrived", "coalesce(sum(n) filter (where kind = 'late'), 0) as late",
        "coalesce(sum(n) filter (where kind = 'changed'), 0) as changed", "coalesce(sum(late_in), 0) as late_arrival_table_days",
        "count_if(late_in > 0) as late_arrival_days")])
    median = events.where("kind = 'arrived'").agg(F.percentile("hours_after_day", F.lit(0.5)).alias("median_arrival_hours"))
    return beside(seen, published, compared, counts, median)


def late_overlap(events: DataFrame, flags: DataFrame) -> DataFrame:
    """How many days that arrived late are among the days the pipeline calls late or rewritten."""
    arrivals = events.where(f"kind = 'arrived' and hours_after_day > {LATE_HOURS}").select("date").distinct()
    flagged = flags.where("pipeline = 'Late or rewritten'").select("date", F.lit(1).alias("f"))
    return arrivals.withColumn("a", F.lit(1)).join(flagged, "date", "full").agg(*[F.expr(e) for e in (
        "count(a) as late_days", "count(f) as flagged_days", "count_if(a = 1 and f = 1) as both",
        "coalesce(every(f is not null) filter (where a is not null), true) as all_flagged")])
