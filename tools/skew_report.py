"""Measure the largest task of the direct and the skew-safe forms when one key
holds a third of all rows. The stand-in input is the driver's events table
shaped as raw export rows with user_pseudo_id NULL on every third event (one
anonymous user then owns a third of the events and sessions); the jobs run
unchanged. Per-task record counts come from Spark's event log, written to a
fresh scratch folder. usage: python tools/skew_report.py [sf_dir]"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(log_dir: str):
    import zstandard

    for f in glob.glob(os.path.join(log_dir, "*", "events_*")) + glob.glob(os.path.join(log_dir, "*")):
        if os.path.isdir(f):
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


PARTITIONS = 64
# Groups and users of more rows than this are split (the defaults, 100,000, are beyond this data).
LARGE = 2_000


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from pyspark.sql import functions as F

    from touchline.operators.events import build_events, exit_flag, flatten_events, seconds_since_previous
    from touchline.operators.traffic import all_event_traffic, event_traffic, session_day_partials, session_traffic
    from touchline.session import build_session, materialize, scratch_path
    from touchline.sources.fixture import driver_raw_events
    from touchline.sources.raw import read_raw, write_shards

    log_dir = tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    # Coalescing off: at this size AQE would merge every partition into a few
    # tasks and hide how rows are distributed over hash partitions.
    spark = build_session("local[8]", app="touchline-skew", shuffle_partitions=PARTITIONS,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false",
                                 # skew-join thresholds scaled down to this data size
                                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB"})
    base = driver_raw_events(spark, sf_dir)
    ep = F.col("event_params")
    # A: a third of the users anonymous, each session keeping its own id, so
    #    the NULL user owns about a third of all sessions.
    hot_user = F.pmod(F.xxhash64("user_pseudo_id"), F.lit(3)) == 0
    shifted = F.transform(ep, lambda p: F.when(
        p["key"] == "ga_session_id",
        F.struct(p["key"].alias("key"), F.struct(
            p["value"]["string_value"].alias("string_value"),
            (p["value"]["int_value"] + F.pmod(F.xxhash64("user_pseudo_id"), F.lit(86400))).alias("int_value"),
            p["value"]["float_value"].alias("float_value"),
            p["value"]["double_value"].alias("double_value")).alias("value"))).otherwise(p))
    scenario_a = base.withColumn("event_params", F.when(hot_user, shifted).otherwise(ep)) \
        .withColumn("user_pseudo_id", F.when(~hot_user, F.col("user_pseudo_id")))
    # B: every third event without user and session ids: one (NULL, NULL)
    #    group owns about a third of all events.
    hot_event = F.col("event_timestamp") % 3 == 0
    no_ids = F.filter(ep, lambda p: ~p["key"].isin("ga_session_id", "ga_session_number"))
    scenario_b = base.withColumn("event_params", F.when(hot_event, no_ids).otherwise(ep)) \
        .withColumn("user_pseudo_id", F.when(~hot_event, F.col("user_pseudo_id")))
    # C: as B, and half of the hot group's events within one minute; half of the
    #    others have an empty user instead of none, so that the id '' is repeated in stg.
    dense = F.lit(1_705_320_000_000_000) + F.pmod(F.xxhash64("event_timestamp"), F.lit(60_000_000))
    none = F.col("user_pseudo_id").isNull()
    scenario_c = scenario_b.withColumn(
        "event_timestamp", F.when(none & (F.col("event_timestamp") % 2 == 0), dense).otherwise(F.col("event_timestamp"))
    ).withColumn("user_pseudo_id", F.when(none & (F.col("event_timestamp") % 4 == 1), F.lit("")).otherwise(
        F.col("user_pseudo_id")))
    raw_a = read_raw(spark, write_shards(scenario_a, scratch_path(spark, "skew-a")))
    raw_b = read_raw(spark, write_shards(scenario_b, scratch_path(spark, "skew-b")))
    raw_c = read_raw(spark, write_shards(scenario_c, scratch_path(spark, "skew-c")))
    n_events = raw_b.count()
    sessions_a = session_traffic(event_traffic(raw_a), method="window")
    n_sessions = sessions_a.count()
    n_hot_sessions = sessions_a.where(F.col("user_pseudo_id").isNull()).count()
    n_hot_events = raw_b.where(F.col("user_pseudo_id").isNull()).count()

    runs = {
        "A: stg, direct RANGE window": lambda: session_traffic(event_traffic(raw_a), method="window"),
        "A: stg, large users split": lambda: session_traffic(event_traffic(raw_a), large_user=LARGE),
        "A: stg from stored day partials, large users split": lambda: session_traffic(
            None, partials=materialize(session_day_partials(all_event_traffic(raw_a))), large_user=LARGE),
        "B: LAG, direct window": lambda: seconds_since_previous(flatten_events(raw_b), "window"),
        "B: LAG, large groups split": lambda: seconds_since_previous(flatten_events(raw_b), large_group=LARGE),
        "B: exit flag, grouped max joined back (AQE skew join)": lambda: exit_flag(flatten_events(raw_b), "aggregate"),
        "B: exit flag, buckets": lambda: exit_flag(flatten_events(raw_b), "bucketed"),
        "B: full events table, direct windows": lambda: build_events(
            raw_b, session_traffic(event_traffic(raw_b)), "window"),
        "B: full events table, large groups split": lambda: build_events(
            raw_b, session_traffic(event_traffic(raw_b)), large_group=LARGE),
        "C: LAG with a dense minute, large groups split": lambda: seconds_since_previous(
            flatten_events(raw_c), large_group=LARGE),
        "C: full events table, hot id repeated in stg, split": lambda: build_events(
            raw_c, session_traffic(event_traffic(raw_c)), large_group=LARGE),
    }
    for name, build in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        df = build()
        df.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("done", "done")
    spark.stop()

    stage_group, worst, stage_max, stage_total = {}, {}, {}, {}
    for e in _events(log_dir):
        if e["Event"] == "SparkListenerJobStart":
            group = e.get("Properties", {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                stage_group[s] = group
        elif e["Event"] == "SparkListenerTaskEnd" and stage_group.get(e["Stage ID"]) in runs:
            m = e["Task Metrics"]
            recs = m["Shuffle Read Metrics"]["Total Records Read"]
            g, sid = stage_group[e["Stage ID"]], e["Stage ID"]
            worst[g] = max(worst.get(g, 0), recs)
            stage_max[sid] = max(stage_max.get(sid, 0), recs)
            stage_total[sid] = stage_total.get(sid, 0) + recs
    # stages that move (nearly) every row of the scenario: sessions for A, events for B
    full_rows = {g: (n_sessions if g.startswith("A") else n_events) for g in runs}
    worst_full = {}
    for sid, total in stage_total.items():
        g = stage_group[sid]
        if total >= 0.9 * full_rows[g]:
            worst_full[g] = max(worst_full.get(g, 0), stage_max[sid])
    lines = [
        f"# Largest task under skew ({os.path.basename(sf_dir)}, local[8], {PARTITIONS} shuffle partitions, "
        "AQE on, partition coalescing off)",
        "",
        f"A: {n_sessions} sessions, {n_hot_sessions} ({n_hot_sessions / n_sessions:.0%}) of them on the NULL user.",
        f"B: {n_events} events, {n_hot_events} ({n_hot_events / n_events:.0%}) of them in one (NULL user, NULL session) group.",
        "AQE skew-join thresholds are scaled to the data (256KB) so its splitting shows at this size.",
        "Largest number of shuffled records read by a single task, over all stages of the run",
        "(an even spread would be about total / partitions per stage):",
        "",
        "| run | largest task, any stage | largest task, stages moving all rows |",
        "| --- | --- | --- |",
    ] + [f"| {g} | {worst.get(g, 0)} | {worst_full.get(g, 0)} |" for g in runs] + [
        "",
        f"Groups and users of more than {LARGE} rows are split here, into pieces of as many (the defaults are",
        "100,000 and 50,000). C: as B, with half of the hot group's events in one minute, and an empty user",
        "beside the missing one, so that the session id '' is hot among the events and repeated in stg.",
        "Rows of the joined sides count, too: a stage that joins reads events and their sessions.",
    ]
    text = "\n".join(lines)
    print(text)
    return text


if __name__ == "__main__":
    main(sys.argv)
