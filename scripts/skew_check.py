"""Hot-key check: one user holds a third of the events.

Prints, per operator, the largest share of shuffled records read by one
task (from Spark's event log in a fresh scratch folder).
usage: python scripts/skew_check.py [sf_dir]
"""
import sys, json, glob, os, time, tempfile
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from featurelens.session import get_session
from featurelens.operators import windows
from pyspark.sql import functions as F
scratch = tempfile.mkdtemp(prefix="skew-check-")
logdir = os.path.join(scratch, "ev")
sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
os.makedirs(logdir, exist_ok=True)
spark = get_session("local[8]", shuffle_partitions=16, conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false", "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
    "spark.sql.adaptive.coalescePartitions.enabled": "false"})
spark.sparkContext.setLogLevel("ERROR")
e = spark.read.parquet(f"{sf}/events.parquet")
# a hot user: one third of all rows belong to user 0
e = e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
e = e.withColumn("value", F.when(F.col("value") > 50, F.col("value")))
print("rows", e.count(), "hot", e.where("user_id = 0").count())
for name, fn in [
    ("forward_fill", lambda: windows.forward_fill(e.select("event_id", "user_id", "ts", "value"), "user_id", ["ts", "event_id"], ["value"])),
    ("history_pivot", lambda: windows.history_pivot(e, "user_id", "ts", "event_type", ["click", "error", "purchase", "signup", "view"])),
    ("lookahead", lambda: windows.lookahead_labels(e, "user_id", "ts", "event_type")),
]:
    spark.sparkContext.setJobGroup(name, name)
    t = time.time()
    fn().write.format("noop").mode("overwrite").save()
    print(name, round(time.time() - t, 2))
spark.stop()
# per job group: the largest shuffle-read share of one task in any stage
stage_group, stage_tasks = {}, {}
for f in [p for p in glob.glob(logdir + "/**", recursive=True) if os.path.isfile(p)]:
    for line in open(f):
        ev = json.loads(line)
        if ev["Event"] == "SparkListenerJobStart":
            g = ev.get("Properties", {}).get("spark.jobGroup.id")
            for s in ev["Stage IDs"]:
                stage_group[s] = g
        elif ev["Event"] == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            r = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            stage_tasks.setdefault(ev["Stage ID"], []).append(r)
out = {}
for s, recs in stage_tasks.items():
    g = stage_group.get(s)
    tot = sum(recs)
    if g and tot > 0:
        share = max(recs) / tot
        if share > out.get(g, (0, 0))[0]:
            out[g] = (round(share, 3), tot, len(recs))
print(json.dumps(out))
