"""Change history, corrections and state over ``events`` read as repeated snapshots of user records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldspark.operators import cdc
from fieldspark.plans.base import table
from fieldspark.plans.registry import Registry

REGISTRY = Registry.new()
bind = REGISTRY.bind

CUT = "2024-01-16"
VIEW = """h AS (SELECT 'U' || user_id AS record_id, CAST(user_id % 6 AS INTEGER) AS source, 'R' || strftime(ts, '%Y%m%d') AS retrieval_id, CAST(ts AS DATE) AS retrieved_at, event_id AS arrival,
  '{"k": ' || (event_id % 3) || '}' AS payload, sha256('{"k": ' || (event_id % 3) || '}') AS checksum FROM events),
old AS (SELECT * FROM h WHERE retrieved_at < DATE '2024-01-16'), new AS (SELECT * FROM h WHERE retrieved_at >= DATE '2024-01-16')"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    payload = F.concat(F.lit('{"k": '), (F.col("event_id") % 3).cast("string"), F.lit("}"))
    rows = e.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("record_id"),
        (F.col("user_id") % 6).cast("int").alias("source"),
        F.concat(F.lit("R"), F.date_format("ts", "yyyyMMdd")).alias("retrieval_id"),
        F.col("ts").cast("date").alias("retrieved_at"),
        F.col("event_id").alias("arrival"),
        payload.alias("payload"),
    )
    return cdc.with_checksum(rows)


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    h = history(spark, sf_dir)
    return h.filter(f"retrieved_at < '{CUT}'"), h.filter(f"retrieved_at >= '{CUT}'")


LAST = "l AS (SELECT record_id, arg_max(checksum, (retrieved_at, retrieval_id)) AS known FROM old1 GROUP BY 1), old1 AS (SELECT * FROM o)"
ONE = ", o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_id, retrieved_at ORDER BY arrival DESC) AS n FROM old) WHERE n = 1)"


def one_a_day(rows: DataFrame) -> DataFrame:
    """The last row of each record and day, which makes the last known row of a record unique."""
    w = Window.partitionBy("record_id", "retrieved_at").orderBy(F.desc("arrival"))
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


@bind(
    "h_02_payload_transitions",
    f"""WITH {VIEW}{ONE}, l AS (SELECT record_id, arg_max(checksum, retrieved_at) AS known FROM o GROUP BY 1),
b AS (SELECT new.*, coalesce(lag(checksum) OVER (PARTITION BY record_id ORDER BY retrieved_at, retrieval_id, arrival), known) AS was FROM new LEFT JOIN l USING (record_id))
SELECT record_id, source, retrieval_id, retrieved_at, arrival, payload, checksum FROM b WHERE checksum IS DISTINCT FROM was
  AND NOT EXISTS (SELECT 1 FROM o WHERE o.record_id = b.record_id AND o.retrieval_id = b.retrieval_id AND o.checksum = b.checksum)""",
)
def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = split(spark, sf_dir)
    return cdc.transitions(new, one_a_day(old))


@bind(
    "h_03_corrections",
    f"""WITH {VIEW}, c AS (SELECT *, coalesce(checksum <> lag(checksum) OVER (PARTITION BY record_id ORDER BY retrieved_at, retrieval_id, arrival), false) AS changed FROM h)
SELECT record_id, bool_or(changed) AS corrected, coalesce(max(CASE WHEN changed THEN retrieved_at END), min(retrieved_at)) AS last_corrected_at, count(DISTINCT checksum) AS versions FROM c GROUP BY 1""",
)
def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.corrections(history(spark, sf_dir))


STATE = "SELECT record_id, source, retrieval_id, retrieved_at, arrival, payload, checksum FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY retrieved_at DESC, retrieval_id DESC, arrival DESC) AS n FROM {}) WHERE n = 1"


@bind("h_04_state_merge", f"WITH {VIEW}, kept AS (SELECT * FROM old WHERE source NOT IN (SELECT source FROM new WHERE source IN (0, 1)) UNION ALL SELECT * FROM new) " + STATE.format("kept"))
def merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = split(spark, sf_dir)
    return cdc.merge(old, new, [0, 1])


@bind("w_04_keep_last", f"WITH {VIEW} " + STATE.format("h"))
def keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.latest(history(spark, sf_dir))


@bind("w_03_last_value", f"WITH {VIEW}{ONE} SELECT record_id, arg_max(checksum, retrieved_at) AS known FROM o GROUP BY 1")
def last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.last_known(one_a_day(split(spark, sf_dir)[0]))


@bind("w_01_lagged_checksums", f"WITH {VIEW} SELECT record_id, arrival, checksum, lag(checksum) OVER (PARTITION BY record_id ORDER BY retrieved_at, retrieval_id, arrival) AS before FROM h")
def lagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("record_id").orderBy(*cdc.ORDER)
    return history(spark, sf_dir).select("record_id", "arrival", "checksum", F.lag("checksum").over(w).alias("before"))


@bind("w_02_change_flags", f"WITH {VIEW} SELECT record_id, arrival, coalesce(checksum <> lag(checksum) OVER (PARTITION BY record_id ORDER BY retrieved_at, retrieval_id, arrival), false) AS changed FROM h")
def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("record_id").orderBy(*cdc.ORDER)
    return history(spark, sf_dir).select("record_id", "arrival", F.coalesce(F.col("checksum") != F.lag("checksum").over(w), F.lit(False)).alias("changed"))


@bind("h_06_update_audit", f"WITH {VIEW} SELECT record_id, count(*) AS rows, count(DISTINCT checksum) AS versions, CASE WHEN count(DISTINCT checksum) > 1 THEN 'UPDATED' ELSE 'NO_OP' END AS status FROM new GROUP BY 1 HAVING count(*) > 1")
def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.update_audit(split(spark, sf_dir)[1])


@bind("j_06_changed_records", f"WITH {VIEW}, a AS ({STATE.format('old')}), b AS ({STATE.format('new')}) SELECT record_id, a.checksum AS before, b.checksum AS after FROM a JOIN b USING (record_id) WHERE a.checksum <> b.checksum")
def changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = split(spark, sf_dir)
    return cdc.changed_against(cdc.latest(new), cdc.latest(old))


@bind(
    "j_07_first_seen",
    f"""WITH {VIEW}, a AS ({STATE.format('old')}), b AS ({STATE.format('new')})
SELECT b.record_id, b.source, b.retrieval_id, CASE WHEN a.checksum = b.checksum THEN a.retrieved_at ELSE b.retrieved_at END AS retrieved_at, b.arrival, b.payload, b.checksum FROM b LEFT JOIN a USING (record_id)""",
)
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = split(spark, sf_dir)
    return cdc.first_seen(cdc.latest(new), cdc.latest(old))


@bind("j_04_left_join_last_known", f"WITH {VIEW}{ONE}, l AS (SELECT record_id, arg_max(checksum, retrieved_at) AS known FROM o GROUP BY 1) SELECT record_id, arrival, known FROM new LEFT JOIN l USING (record_id)")
def left_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = split(spark, sf_dir)
    return new.join(cdc.last_known(one_a_day(old)), "record_id", "left").select("record_id", "arrival", "known")


@bind("j_05_idempotent_append", f"WITH {VIEW} SELECT record_id, retrieval_id, checksum, arrival FROM h WHERE arrival % 2 = 0 AND NOT EXISTS (SELECT 1 FROM old WHERE old.record_id = h.record_id AND old.retrieval_id = h.retrieval_id AND old.checksum = h.checksum)")
def append(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    keys = ["record_id", "retrieval_id", "checksum"]
    return h.filter("arrival % 2 = 0").join(h.filter(f"retrieved_at < '{CUT}'").select(*keys), keys, "left_anti").select(*keys, "arrival")


@bind("u_08_replace_by_key", f"WITH {VIEW}, a AS ({STATE.format('old')}), b AS ({STATE.format('new')} AND source < 3) SELECT record_id, checksum FROM a WHERE record_id NOT IN (SELECT record_id FROM b) UNION ALL SELECT record_id, checksum FROM b")
def replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = split(spark, sf_dir)
    a, b = cdc.latest(old), cdc.latest(new).filter("source < 3")
    return a.join(b.select("record_id"), "record_id", "left_anti").select("record_id", "checksum").unionByName(b.select("record_id", "checksum"))


@bind("h_07_fingerprint")
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.fingerprint(history(spark, sf_dir), ["record_id", "retrieval_id", "payload"])


@bind(
    "h_14_coverage",
    f"WITH {VIEW}, c AS (SELECT source, min(retrieved_at) AS start, max(retrieved_at) AS \"end\" FROM h GROUP BY 1) SELECT max(start) AS start, min(\"end\") AS \"end\", max(start) <= min(\"end\") AS verified, max(start) <= min(\"end\") AS overlaps FROM c",
)
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = history(spark, sf_dir).groupBy("source").agg(F.min("retrieved_at").alias("start"), F.max("retrieved_at").alias("end"), F.lit(True).alias("verified"))
    return cdc.coverage(per)


@bind("h_13_observed_bounds", f"WITH {VIEW} SELECT source, min(retrieved_at) AS first_date, max(retrieved_at) AS last_date FROM h GROUP BY 1")
def bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(spark, sf_dir).groupBy("source").agg(F.min("retrieved_at").alias("first_date"), F.max("retrieved_at").alias("last_date"))
