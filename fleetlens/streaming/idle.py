"""A watermark over the partitions of a source that does not wait for silent ones.

Each partition has a watermark of its own: its newest event time less the delay. The source's watermark is the least of
those of its active partitions, so a partition that lags holds it back and loses nothing. A partition that has sent nothing
for the idle timeout, by processing time, is left out until it sends again; rows it then sends from behind the watermark
are late. The watermark never falls, and stays where it is while every partition is idle.

Processing time is a column (when a report arrived), cut into polls; the watermark is taken at the end of each poll. So a
result depends on the reports alone and not on how they fall into micro-batches, and a run can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from fleetlens.operators.upsert import BatchId, append_history, has_version, read_table, write_version
from fleetlens.schemas import TableSpec

PARTITION, ARRIVED = "source_partition", "arrived"

MARKS = TableSpec(
    "source_marks", ("janela_fim",),
    StructType([StructField("janela_fim", TimestampType()), StructField("watermark", TimestampType()),
                StructField("active", LongType()), StructField("idle", LongType()), StructField("rows", LongType()),
                StructField("late", LongType())]),
    optional=("watermark",), updated="janela_fim",
)

# Rows of the state: what each partition sent up to the last closed poll, what it sent in the open poll, the watermark.
KNOWN, OPEN, MARK = "known", "open", "mark"
STATE = StructType([
    StructField("role", StringType()), StructField(PARTITION, IntegerType()), StructField("poll", TimestampType()),
    StructField("newest", TimestampType()), StructField("seen", TimestampType()), StructField("rows", LongType()),
    StructField("late", LongType()),
])


def is_active(now: Column, seen: Column, idle_us: int) -> Column:
    return F.unix_micros(now) - F.unix_micros(seen) <= idle_us


def least_active(newest: Column, seen: Column, now: Column, idle_us: int | None) -> Column:
    """Aggregate: the least newest time of the active partitions; NULL if none is active."""
    return F.min(newest) if idle_us is None else F.min(F.when(is_active(now, seen, idle_us), newest))


def poll_of(arrived: Column, poll_seconds: int) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_seconds(arrived) / poll_seconds) * poll_seconds)


def _sent(rows: DataFrame, poll_seconds: int) -> DataFrame:
    """One row per partition and poll."""
    return rows.where(F.col("event_time").isNotNull() & F.col(ARRIVED).isNotNull()).groupBy(
        poll_of(F.col(ARRIVED), poll_seconds).alias("poll"), PARTITION).agg(
        F.max("event_time").alias("newest"), F.max(ARRIVED).alias("seen"), F.count(F.lit(1)).alias("rows"))


def _marks(sent: DataFrame, known: DataFrame, before: Column, poll_seconds: int, delay_us: int, idle_us: int) -> DataFrame:
    """``poll``, ``ends``, ``watermark`` and numbers of active and idle partitions at the end of every poll of ``sent``.

    Partitions are few (they are a topic's); a row is made for each of them at every poll, and what it last sent is carried
    there by a window.
    """
    ends = F.col("poll") + F.expr(f"INTERVAL {poll_seconds} SECONDS")
    names = [r[0] for r in sent.select(PARTITION).union(known.select(PARTITION)).distinct().collect()]
    polls = sent.select("poll").distinct().select("poll", F.explode(F.array(*[F.lit(n) for n in names])).alias(PARTITION))
    given = sent.select("poll", PARTITION, "newest", "seen").unionByName(
        known.select(F.lit(0).cast("timestamp").alias("poll"), PARTITION, "newest", "seen")).unionByName(
        polls.withColumns({"newest": F.lit(None).cast("timestamp"), "seen": F.lit(None).cast("timestamp")}))
    so_far = Window.partitionBy(PARTITION).orderBy("poll").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    carried = given.select("poll", PARTITION, F.max("newest").over(so_far).alias("newest"), F.max("seen").over(so_far).alias("seen"))
    carried = carried.join(polls, ["poll", PARTITION]).distinct().withColumn("ends", ends).where(F.col("seen").isNotNull())
    active = is_active(F.col("ends"), F.col("seen"), idle_us)
    each = carried.groupBy("poll", "ends").agg(
        least_active(F.col("newest"), F.col("seen"), F.col("ends"), idle_us).alias("least"),
        F.count_if(active).alias("active"), F.count_if(~active).alias("idle"))
    rising = Window.orderBy("poll").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mark = F.timestamp_micros(F.unix_micros("least") - delay_us)
    return each.select("poll", "ends", "active", "idle", F.greatest(F.max(mark).over(rising), before).alias("watermark"))


def track(batch: DataFrame, number: BatchId, out: str, path: str, poll_seconds: int, delay_us: int, idle_us: int, keep_seconds: int) -> None:
    """Move the partitions' state on by a micro-batch, and add the watermarks of the polls that it closes to a history table.

    A poll is closed when a report arrives in a later one.
    """
    spark: SparkSession = batch.sparkSession
    if has_version(spark, path, number):
        return
    state = read_table(spark, path, STATE).persist()
    fresh = _sent(batch, poll_seconds).persist()
    try:
        known, open_ = (state.where(F.col("role") == role) for role in (KNOWN, OPEN))
        before = F.lit(state.where(F.col("role") == MARK).agg(F.max("newest")).first()[0]).cast("timestamp")
        sent = fresh.unionByName(open_.select(*fresh.columns)).groupBy("poll", PARTITION).agg(
            F.max("newest").alias("newest"), F.max("seen").alias("seen"), F.sum("rows").alias("rows"))
        newest = sent.agg(F.max("poll")).first()[0]
        if newest is None:
            return
        marks = _marks(sent, known, before, poll_seconds, delay_us, idle_us).persist()
        # The watermark that a poll's rows meet is that of the poll before.
        earlier = Window.orderBy("poll")
        met = marks.select("poll", F.coalesce(F.lag("watermark").over(earlier), before).alias("met"))
        timed = batch.where(F.col("event_time").isNotNull() & F.col(ARRIVED).isNotNull()).select(
            poll_of(F.col(ARRIVED), poll_seconds).alias("poll"), PARTITION, "event_time").join(met, "poll")
        late = timed.where(F.col("event_time") <= F.col("met")).groupBy("poll", PARTITION).agg(F.count(F.lit(1)).alias("late"))
        late = late.unionByName(open_.select("poll", PARTITION, "late")).groupBy("poll", PARTITION).agg(F.sum("late").alias("late"))
        full = sent.join(late, ["poll", PARTITION], "left").withColumn("late", F.coalesce("late", F.lit(0).cast("long"))).persist()
        closed = F.col("poll") < F.lit(newest)
        counts = full.where(closed).groupBy("poll").agg(F.sum("rows").alias("rows"), F.sum("late").alias("late"))
        done = counts.join(marks, "poll").select(F.col("ends").alias("janela_fim"), "watermark", "active", "idle", "rows", "late")
        append_history(done, number, out, MARKS)
        none = {"poll": F.lit(None).cast("timestamp"), "rows": F.lit(None).cast("long"), "late": F.lit(None).cast("long")}
        kept = full.where(closed).select(PARTITION, "newest", "seen").unionByName(known.select(PARTITION, "newest", "seen")).groupBy(
            PARTITION).agg(F.max("newest").alias("newest"), F.max("seen").alias("seen")).withColumns({"role": F.lit(KNOWN), **none})
        going = full.where(~closed).withColumn("role", F.lit(OPEN))
        mark = marks.where(closed).agg(F.greatest(F.max("watermark"), before).alias("newest")).withColumns({
            "role": F.lit(MARK), PARTITION: F.lit(None).cast("int"), "seen": F.lit(None).cast("timestamp"), **none})
        after = kept.select(*STATE.names).unionByName(going.select(*STATE.names)).unionByName(mark.select(*STATE.names))
        write_version(after, path, number, keep_seconds)
    finally:
        state.unpersist()
        fresh.unpersist()
