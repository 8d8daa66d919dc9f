"""Cleaning of provider fields, adapters of feeds and collection state bound to the tables."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.functions import temporal as D
from fieldspark.functions import text as X
from fieldspark.functions.geo import Box, grid_cell, haversine_km
from fieldspark.operators import cdc
from fieldspark.plans.base import sightings, table, with_sightings
from fieldspark.plans.registry import Registry
from fieldspark.sources import readers

REGISTRY = Registry.new()
bind = REGISTRY.bind

MISSING = "('nan', 'na', 'n/a', 'none', 'null')"
#: Text with the usual ways to say that a value is missing.
RAW = "r AS (SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN ' N/A ' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'NaN' WHEN 4 THEN '   ' ELSE '  ' || source || ' ' END AS v FROM documents)"


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 9
    v = F.when(k == 0, " N/A ").when(k == 1, "").when(k == 2, F.lit(None)).when(k == 3, "NaN").when(k == 4, "   ").otherwise(F.concat(F.lit("  "), F.col("source"), F.lit(" ")))
    return table(spark, sf_dir, "documents").select("doc_id", v.alias("v"))


@bind("c_02_source_text", f"WITH {RAW} SELECT doc_id, CASE WHEN trim(v) <> '' AND lower(trim(v)) NOT IN {MISSING} THEN trim(v) END AS v FROM r")
def source_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("doc_id", X.source_text(F.col("v")).alias("v"))


@bind("c_09_present", f"WITH {RAW} SELECT doc_id, v IS NOT NULL AND trim(v) <> '' AND lower(v) <> 'nan' AS present FROM r")
def present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).select("doc_id", F.coalesce(X.present(F.col("v")), F.lit(False)).alias("present"))


@bind(
    "c_11_local_to_utc",
    """WITH n AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-03-10 00:00:00' ELSE TIMESTAMP '2024-11-03 00:00:00' END + INTERVAL 1 MINUTE * (event_id % 240) AS t FROM events),
u AS (SELECT event_id, t, timezone('UTC', timezone('America/Los_Angeles', t)) AS utc FROM n), b AS (SELECT *, timezone('America/Los_Angeles', timezone('UTC', utc)) AS back,
 timezone('America/Los_Angeles', timezone('UTC', utc - INTERVAL 1 HOUR)) AS early, timezone('America/Los_Angeles', timezone('UTC', utc + INTERVAL 1 HOUR)) AS late FROM u)
SELECT event_id, CASE WHEN back = t AND early <> t AND late <> t THEN utc END AS utc FROM b""",
)
def local_to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall-clock times around both changes of the clock: skipped and repeated ones have no instant."""
    day = F.when(F.col("event_id") % 2 == 0, "2024-03-10 00:00:00").otherwise("2024-11-03 00:00:00").cast("timestamp")
    naive = day + F.make_dt_interval(mins=(F.col("event_id") % 240).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", D.local_to_utc(naive, "America/Los_Angeles").alias("utc"))


UNCERTAIN = "u AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '-5' WHEN 1 THEN 'nan' WHEN 2 THEN 'inf' WHEN 3 THEN 'about 30' ELSE CAST(user_id AS VARCHAR) END AS raw FROM events)"


@bind("c_15_uncertainties", f"WITH {UNCERTAIN} SELECT event_id, CASE WHEN isfinite(TRY_CAST(raw AS DOUBLE)) AND TRY_CAST(raw AS DOUBLE) >= 0 THEN TRY_CAST(raw AS DOUBLE) END AS metres FROM u")
def uncertainties(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 5
    text = F.when(k == 0, "-5").when(k == 1, "nan").when(k == 2, "inf").when(k == 3, "about 30").otherwise(F.col("user_id").cast("string"))
    x = text.try_cast("double")
    return table(spark, sf_dir, "events").select("event_id", F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")) & (x >= 0), x).alias("metres"))


@bind("c_18_canonical_json", """SELECT event_id, sha256('{"event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' || user_id || '}') AS digest FROM events""")
def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.sha2(X.canonical_json(user_id=F.col("user_id"), event_type=F.col("event_type"), event_id=F.col("event_id")), 256).alias("digest"))


@bind("c_19_day_of_parts", "SELECT event_id, TRY_CAST(printf('%04d-%02d-%02d', 2023 + event_id % 2, 1 + event_id % 14, 1 + event_id % 33) AS DATE) AS day FROM events")
def day_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", D.day_of_parts(2023 + k % 2, 1 + k % 14, 1 + k % 33).alias("day"))


INSTANT = """t AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '/' || strftime(ts, '%Y-%m-%d') WHEN 2 THEN 'soon' WHEN 3 THEN '2024-13-01T10:00:00'
 WHEN 4 THEN strftime(ts, ' %Y-%m-%d %H:%M:%S ') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS v FROM events)"""


@bind("c_20_precise_timestamps", f"WITH {INSTANT} SELECT event_id, CASE WHEN NOT contains(v, '/') AND (contains(trim(v), 'T') OR regexp_matches(substr(trim(v), 11), '[0-9]')) AND TRY_CAST(trim(v) AS TIMESTAMP) IS NOT NULL THEN trim(v) END AS instant FROM t")
def precise(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, f = F.col("event_id") % 6, lambda pattern: F.date_format("ts", pattern)
    v = (
        F.when(k == 0, f("yyyy-MM-dd")).when(k == 1, F.concat(f("yyyy-MM-dd'T'HH:mm:ss"), F.lit("/"), f("yyyy-MM-dd"))).when(k == 2, "soon").when(k == 3, "2024-13-01T10:00:00")
        .when(k == 4, f(" yyyy-MM-dd HH:mm:ss ")).otherwise(f("yyyy-MM-dd'T'HH:mm:ss"))
    )
    return table(spark, sf_dir, "events").select("event_id", X.precise_timestamp(v).alias("instant"))


@bind("c_21_coordinate_ranges", "SELECT event_id, (value - 250) BETWEEN -90 AND 90 AND (value * 2 - 400) BETWEEN -180 AND 180 AS usable FROM events")
def coordinate_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    world = Box(-90, 90, -180, 180)
    return table(spark, sf_dir, "events").select("event_id", world.covers(F.col("value") - 250, F.col("value") * 2 - 400).alias("usable"))


MARKER = "m AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN strftime(ts, '%b %-d,, %Y') WHEN 1 THEN strftime(ts, '%b %-d,%Y') WHEN 2 THEN strftime(ts, '%b. %-d, 202') WHEN 3 THEN strftime(ts, '%B %-d') WHEN 4 THEN 'Sept 3, 2023' WHEN 5 THEN ' ' ELSE 'some day, 2024' END AS v FROM events)"


@bind(
    "c_23_marker_dates",
    f"""WITH {MARKER}, a AS (SELECT event_id, v, regexp_replace(trim(v), '\\bSept\\b', 'Sep', 'i') AS t FROM m),
b AS (SELECT *, contains(t, ',,') OR regexp_matches(t, ',\\d{{4}}$') AS odd, regexp_replace(regexp_replace(replace(t, ',,', ','), ',(\\d{{4}})$', ', \\1'), '^([A-Za-z]{{3}})\\.', '\\1') AS u FROM a),
c AS (SELECT *, regexp_matches(u, ',\\s*\\d{{3}}$') AS cut, NOT regexp_matches(u, ',\\s*\\d{{3}}$') AND NOT regexp_matches(u, '(,\\s*(\\d{{2}}|\\d{{4}})|\\s+\\d{{4}})$') AS bare FROM b),
d AS (SELECT *, CASE WHEN cut THEN regexp_replace(u, ',\\s*\\d{{3}}$', ', 2024') WHEN bare THEN u || ', 2024' ELSE u END AS w FROM c),
e AS (SELECT *, CAST(coalesce(try_strptime(w, '%b %d, %Y'), try_strptime(w, '%B %d, %Y')) AS DATE) AS day FROM d)
SELECT event_id, CASE WHEN trim(v) <> '' THEN day END AS day, CASE WHEN trim(v) = '' THEN 'MISSING_ATLIST_DATE' ELSE concat_ws(';', CASE WHEN odd THEN 'ATLIST_DATE_TEXT_NORMALIZED' END, CASE WHEN cut THEN 'ATLIST_DATE_YEAR_REPAIRED' END,
 CASE WHEN bare THEN 'ATLIST_DATE_YEAR_INFERRED' END, CASE WHEN year(day) <> 2024 THEN 'ATLIST_MAP_YEAR_DATE_MISMATCH' END, CASE WHEN day IS NULL THEN 'UNPARSED_ATLIST_DATE' END) END AS flags FROM e""",
)
def marker_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, f = F.col("event_id") % 7, lambda pattern: F.date_format("ts", pattern)
    v = F.when(k == 0, f("MMM d,, yyyy")).when(k == 1, f("MMM d,yyyy")).when(k == 2, f("MMM. d, '202'")).when(k == 3, f("MMMM d")).when(k == 4, "Sept 3, 2023").when(k == 5, " ").otherwise("some day, 2024")
    got = X.map_marker_date(v, 2024)
    return table(spark, sf_dir, "events").select("event_id", got["date"].alias("day"), F.array_join(got["flags"], ";").alias("flags"))


@bind(
    "c_24_clock_texts",
    """WITH t AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%-H:%M') WHEN 1 THEN strftime(ts, '%H:%M:%S') WHEN 2 THEN strftime(ts, ' %-I:%M ') || lower(strftime(ts, '%p')) WHEN 3 THEN strftime(ts, '%H%M') ELSE 'noon' END AS v FROM events)
SELECT event_id, strftime(coalesce(try_strptime(upper(trim(v)), '%-H:%M'), try_strptime(upper(trim(v)), '%-H:%M:%S'), try_strptime(upper(trim(v)), '%-I:%M %p'), try_strptime(upper(trim(v)), '%H%M')), '%H:%M') AS clock FROM t""",
)
def clock_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, f = F.col("event_id") % 5, lambda pattern: F.date_format("ts", pattern)
    v = F.when(k == 0, f("H:mm")).when(k == 1, f("HH:mm:ss")).when(k == 2, F.concat(f(" h:mm "), F.lower(f("a")))).when(k == 3, f("HHmm")).otherwise("noon")
    return table(spark, sf_dir, "events").select("event_id", D.clock_text(v).alias("clock"))


@bind(
    "c_27_coordinate_pairs",
    """WITH p AS (SELECT event_id, printf('%d.%03d / -%d.%03d', 40 + event_id % 15, event_id % 1000, 110 + event_id % 25, event_id % 500) AS v FROM events), c AS (SELECT event_id, TRY_CAST(split_part(v, ' / ', 1) AS DOUBLE) AS lat, TRY_CAST(split_part(v, ' / ', 2) AS DOUBLE) AS lon FROM p)
SELECT event_id, CASE WHEN lat BETWEEN 46 AND 52 AND lon BETWEEN -130 AND -120 THEN lat END AS lat, CASE WHEN lat BETWEEN 46 AND 52 AND lon BETWEEN -130 AND -120 THEN lon END AS lon FROM c""",
)
def coordinate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    text = F.format_string("%d.%03d / -%d.%03d", 40 + k % 15, k % 1000, 110 + k % 25, k % 500)
    parts = F.split(text, "/", 2)
    lat, lon = (X.coordinate_component(F.trim(F.get(parts, F.lit(i))), axis) for i, axis in enumerate(("lat", "lon")))
    inside = Box(46, 52, -130, -120).covers(lat, lon)
    return table(spark, sf_dir, "events").select("event_id", F.when(inside, lat).alias("lat"), F.when(inside, lon).alias("lon"))


ALIASES = {"date": "encounter_date", "encounterdate": "encounter_date", "pods": "pods", "time": "start_time"}


@bind(
    "c_30_paragraph_fields",
    """WITH h AS (SELECT event_id, '<h1>Encounter</h1><p><b>Encounter Date:</b> ' || strftime(ts, '%Y-%m-%d') || '</p><p>Date: later</p>
<p class="x">' || CASE WHEN event_id % 3 = 0 THEN 'PODS' ELSE 'Ships' END || ':  J ' || (user_id % 7) || '</p><p>no label</p>' AS html FROM events),
l AS (SELECT event_id, list_transform(regexp_extract_all(html, '(?is)<p\\b[^>]*>(.*?)</p>', 1), lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))) AS lines FROM h),
k AS (SELECT event_id, list_transform(list_filter(lines, lambda x: regexp_matches(x, '^[^:]{1,50}:')), lambda x: {'k': regexp_replace(lower(split_part(x, ':', 1)), '[^a-z0-9]', '', 'g'), 'v': trim(substr(x, instr(x, ':') + 1))}) AS f FROM l)
SELECT event_id, list_filter(f, lambda x: x.k IN ('date', 'encounterdate'))[1].v AS encounter_date, list_filter(f, lambda x: x.k = 'pods')[1].v AS pods FROM k""",
)
def paragraph_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.concat(
        F.lit("<h1>Encounter</h1><p><b>Encounter Date:</b> "), F.date_format("ts", "yyyy-MM-dd"), F.lit('</p><p>Date: later</p>\n<p class="x">'), F.when(F.col("event_id") % 3 == 0, "PODS").otherwise("Ships"),
        F.lit(":  J "), (F.col("user_id") % 7).cast("string"), F.lit("</p><p>no label</p>"),
    )
    got = X.paragraph_fields(html, ALIASES)
    return table(spark, sf_dir, "events").select("event_id", got["encounter_date"].alias("encounter_date"), got["pods"].alias("pods"))


@bind("c_32_tag_names", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'seen;' || event_type WHEN 1 THEN event_type ELSE '' END AS tags FROM events")
def tag_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 3
    named = F.concat(F.lit('{"name":"'), F.col("event_type"), F.lit('"}'))
    tags = F.when(k == 0, F.concat(F.lit('["seen",'), named, F.lit("]"))).when(k == 1, F.concat(F.lit('[{"id":3},'), named, F.lit(',""]'))).otherwise("[]")
    return table(spark, sf_dir, "events").select("event_id", F.array_join(X.tag_names(tags), ";").alias("tags"))


@bind("c_35_header_names", "SELECT column_name AS name, trim(regexp_replace(replace(lower(column_name), '_', ' '), '\\s+', ' ', 'g')) AS header FROM (DESCRIBE lineitem) WHERE column_name IS NOT NULL")
def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header names of a table in canonical form: a driver-side list of its columns."""
    return spark.createDataFrame([(c, X.header_name(c)) for c in table(spark, sf_dir, "lineitem").columns], "name string, header string")


@bind("c_38_eras", "SELECT o_orderkey, (year(o_orderdate) // 5 * 5) || '-' || (year(o_orderdate) // 5 * 5 + 4) AS era FROM orders")
def eras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", D.era(F.col("o_orderdate")).alias("era"))


@bind("c_41_week_starts", "SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week, count(*) AS n FROM orders GROUP BY 1")
def weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(D.week_start(F.col("o_orderdate")).alias("week")).agg(F.count(F.lit(1)).alias("n"))


@bind("c_44_year_waves", "SELECT o_orderkey, round(sin(2 * pi() * dayofyear(o_orderdate) / 365.25), 9) AS s, round(cos(2 * pi() * dayofyear(o_orderdate) / 365.25), 9) AS c FROM orders")
def waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, c = D.year_wave(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(s, 9).alias("s"), F.round(c, 9).alias("c"))


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records of a feed, with the fields that events have under changing names."""
    k = F.col("event_id")
    fields = F.struct(
        F.when(k % 2 == 0, k.cast("string")).alias("entry_id"), k.cast("string").alias("id"), F.when(k % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("observed_at"), F.date_format("ts", "yyyy-MM-dd").alias("created"),
        F.when(k % 4 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("latitude"), F.lit("48.5").alias("lat"), F.col("event_type").alias("type"), F.when(k % 5 == 0, "").otherwise("seen").alias("comments"), F.lit("J").alias("pod"),
        F.when(k % 7 == 0, " RWSAS ").otherwise("own").alias("source"), F.when(k % 11 == 0, "Yes").otherwise("0").alias("is_test"), F.when(k % 2 == 0, F.col("event_type")).otherwise("Orcinus orca").alias("scientific_name"), F.col("event_type").alias("name"),
    )
    return table(spark, sf_dir, "events").select(F.to_json(fields).alias("payload"))


@bind(
    "c_05_priority_feed",
    """SELECT 'FEED:' || event_id AS record_id, CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d') END AS observed_at_raw, event_type AS species, CASE WHEN event_id % 5 <> 0 THEN 'seen' END AS description,
 CASE WHEN event_id % 4 = 0 THEN '48.5' ELSE 'own' END AS latitude_of, 'J' AS label_raw FROM events""",
)
def priority_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.priority_feed(_feed(spark, sf_dir), "feed")
    return rows.select("record_id", "observed_at_raw", "species", "description", F.when(F.col("latitude_raw") == F.get_json_object("payload", "$.latitude"), "own").otherwise(F.col("latitude_raw")).alias("latitude_of"), "label_raw")


@bind("c_06_mirrored_feed", "SELECT 'MIRROR:' || event_id AS record_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'Orcinus orca | ' || event_type END AS species, event_type AS label_raw FROM events WHERE event_id % 7 <> 0 AND event_id % 11 <> 0")
def mirrored_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.mirrored_feed(_feed(spark, sf_dir), "mirror").select("record_id", "species", "label_raw")


@bind(
    "c_04_community_feed",
    """SELECT 'INAT:' || event_id AS record_id, CASE WHEN event_id % 2 = 0 THEN '48.25' ELSE '47.5' END AS latitude_raw, CASE WHEN event_id % 3 = 0 OR event_id % 5 = 0 THEN 'QUARANTINED' ELSE 'ACCEPTED' END AS qc_status,
 CASE WHEN event_id % 5 <> 0 THEN CAST(user_id AS DOUBLE) END AS uncertainty_m, CASE WHEN event_id % 4 = 0 THEN 'Bay' ELSE 'a fin | Bay' END AS description FROM events""",
)
def community_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    point = F.when(k % 2 == 0, F.struct(F.array(F.lit(-123.5), F.lit(48.25)).alias("coordinates")))
    fields = F.struct(
        k.cast("string").alias("id"), F.lit("47.5").alias("latitude"), F.lit("-122.5").alias("longitude"), point.alias("geojson"), F.when(k % 5 == 0, -1.0).otherwise(F.col("user_id").cast("double")).alias("positional_accuracy"),
        (k % 3 == 0).alias("captive"), F.when(k % 4 == 0, " ").otherwise("a fin").alias("description"), F.lit("Bay").alias("place_guess"), F.date_format("ts", "yyyy-MM-dd").alias("observed_on"),
    )
    rows = readers.community_feed(table(spark, sf_dir, "events").select(F.to_json(fields).alias("payload")), "inat")
    return rows.select("record_id", "latitude_raw", "qc_status", "uncertainty_m", "description")


@bind("c_07_flat_files", """SELECT 'TWM:sha256:' || substr(sha256('{"comments":"' || event_type || '","date":"' || strftime(ts, '%Y-%m-%d') || '","time":"' || strftime(ts, '%H:%M:%S') || '"}'), 1, 24) AS record_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS observed_at_raw, event_type AS description FROM events""")
def flat_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without an id are told by a digest of their identity fields."""
    files = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.date_format("ts", "HH:mm:ss").alias("time"), F.col("event_type").alias("comments"), F.lit("").alias("id"))
    return readers.csv_provider(files, "twm", ["date", "time", "comments"]).select("record_id", "observed_at_raw", "description")


ERAS = [("CLICK", "2024-01-03", "2024-01-12"), ("VIEW", "2024-01-10", "2024-01-20"), ("CLICK", "2024-01-25", "2024-01-27")]


@bind("p_09_certified_strata", "SELECT event_id, (event_type = 'click' AND (ts::DATE BETWEEN DATE '2024-01-03' AND DATE '2024-01-12' OR ts::DATE BETWEEN DATE '2024-01-25' AND DATE '2024-01-27')) OR (event_type = 'view' AND ts::DATE BETWEEN DATE '2024-01-10' AND DATE '2024-01-20') AS certified FROM events")
def certified_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows within a reviewed list of source and era selectors, which is a handful of constants."""
    day, source = F.col("ts").cast("date"), F.upper("event_type")
    hit = F.lit(False)
    for name, start, end in ERAS:
        hit = hit | ((source == name) & day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return table(spark, sf_dir, "events").select("event_id", hit.alias("certified"))


NEEDED, BARRED = ("policy", "supported", "domain", "evaluated", "stable", "stratum", "validated"), ("conflict",)
FLAGS = {"policy": 2, "supported": 3, "domain": 5, "evaluated": 7, "stable": 11, "stratum": 13, "validated": 17, "conflict": 4}


@bind("p_10_soft_mass_eligibility", "SELECT event_id, " + " AND ".join(f"event_id % {m} <> 0" for k, m in FLAGS.items() if k != "conflict") + " AND event_id % 4 <> 1 AS eligible FROM events")
def soft_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mass counts only where every needed flag is known to hold and no barring one does: unknown flags refuse."""
    e = table(spark, sf_dir, "events")
    for k, m in FLAGS.items():
        e = e.withColumn(k, F.col("event_id") % m == 1 if k in BARRED else F.when(F.col("event_id") % m != 0, True))
    ok = F.lit(True)
    for k in NEEDED:
        ok = ok & F.coalesce(F.col(k), F.lit(False))
    for k in BARRED:
        ok = ok & ~F.coalesce(F.col(k), F.lit(True))
    return e.select("event_id", ok.alias("eligible"))


@bind("p_11_anchor_eligibility", with_sightings("SELECT observation_id, detail IN ('SRKW', 'TRANSIENT') AND least(1, greatest(0, value / 300.0)) > 0.1 AS anchor FROM s"))
def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("value") / 300.0))
    return sightings(spark, sf_dir).select("observation_id", (F.col("detail").isin("SRKW", "TRANSIENT") & (weight > 0.1)).alias("anchor"))


@bind("m_01_model_frame", with_sightings("SELECT observation_id, CASE WHEN detail IN ('SRKW', 'TRANSIENT') THEN detail WHEN detail = 'OFFSHORE' THEN 'OTHER' END AS model_class, round(least(1, greatest(0, (value - 100) / 300.0)), 9) AS weight, sighting_date FROM s"))
def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes that a model knows, weights held to [0, 1], dates without a time of day."""
    label = F.when(F.col("detail").isin("SRKW", "TRANSIENT"), F.col("detail")).when(F.col("detail").isin("OFFSHORE", "NRKW"), "OTHER")
    weight = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce((F.col("value") - 100) / 300.0, F.lit(1.0))))
    return sightings(spark, sf_dir).select("observation_id", label.alias("model_class"), F.round(weight, 9).alias("weight"), F.col("event_at").cast("date").alias("sighting_date"))


HISTORY = "h AS (SELECT event_id % 500 AS record_id, event_id, ts, CASE WHEN event_id % 3 = 0 THEN '{\"_source_file\":\"a.csv\"}' ELSE props END AS payload FROM events)"


@bind("h_05_row_priority", f"WITH {HISTORY} SELECT record_id, event_id FROM h QUALIFY row_number() OVER (PARTITION BY record_id, ts::DATE ORDER BY contains(payload, '\"_source_file\":'), event_id) = 1".replace("SELECT record_id, event_id FROM h QUALIFY", "SELECT record_id, event_id, ts::DATE AS day FROM h QUALIFY"))
def row_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At one retrieval time a row of the service beats one of a bulk file."""
    e = table(spark, sf_dir, "events")
    payload = F.when(F.col("event_id") % 3 == 0, '{"_source_file":"a.csv"}').otherwise(F.col("props"))
    bulk = F.instr(payload, '"_source_file":') > 0
    return e.groupBy((F.col("event_id") % 500).alias("record_id"), F.col("ts").cast("date").alias("day")).agg(F.min_by("event_id", F.struct(bulk.alias("b"), F.col("event_id").alias("e"))).alias("event_id"))


@bind("h_09_next_starts", "SELECT user_id, greatest(DATE '2024-01-15', max(ts)::DATE - 14) AS start FROM events GROUP BY 1")
def next_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First day of each source's next collection, as ``cdc.next_start`` says it for one."""
    last = F.max("ts").cast("date")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.greatest(F.lit(date(2024, 1, 15)), F.date_sub(last, 14)).alias("start"))


@bind("h_10_watermark_refusals", "SELECT user_id, max(ts)::DATE AS watermark FROM events GROUP BY 1 HAVING max(ts)::DATE > DATE '2024-01-28'")
def refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources whose published watermark lies after the end of a window that is asked for."""
    return cdc.behind_watermark(table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").cast("date").alias("watermark")), date(2024, 1, 28))


@bind("h_11_scope_hashes", """SELECT r_regionkey, sha256('{"full_area":[46,52],"source":"' || r_name || '","start":"2020-01-0' || (1 + r_regionkey) || '"}') AS scope FROM region""")
def scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity of a source's selection: settings, area and start, whatever the end."""
    rows = table(spark, sf_dir, "region").collect()  # five settings of sources
    return spark.createDataFrame([(r["r_regionkey"], cdc.scope_hash(r["r_name"], [46, 52], date(2020, 1, 1 + r["r_regionkey"]))) for r in rows], "r_regionkey int, scope string")


@bind("h_12_snapshot_modes", "SELECT user_id, CASE WHEN count(*) > 40 THEN 'DELTA_UPSERT' ELSE 'FULL_REPLACE' END AS mode FROM events GROUP BY 1")
def modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source with state is updated, one without is loaded whole."""
    state = table(spark, sf_dir, "events").groupBy("user_id").agg((F.count(F.lit(1)) > 40).alias("has_state"))
    return state.select("user_id", cdc.snapshot_mode(F.col("has_state")).alias("mode"))


@bind("g_12_planar_cells", with_sightings("SELECT observation_id, floor(lat * 110.574 / 5)::BIGINT AS cell_row, floor(lon * 111.320 * cos(radians(lat)) / 5)::BIGINT AS cell_col FROM s"))
def planar(spark: SparkSession, sf_dir: str) -> DataFrame:
    row, col = grid_cell(F.col("lat"), F.col("lon"), 5.0)
    return sightings(spark, sf_dir).select("observation_id", row.alias("cell_row"), col.alias("cell_col"))


@bind("g_14_haversine_km", with_sightings("SELECT a.observation_id, round(2 * 6371.0088 * asin(sqrt(power(sin((radians(48.5) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(48.5)) * power(sin((radians(-123.0) - radians(a.lon)) / 2), 2))), 6) AS km FROM s a"))
def kilometres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(spark, sf_dir).select("observation_id", F.round(haversine_km(F.col("lat"), F.col("lon"), F.lit(48.5), F.lit(-123.0)), 6).alias("km"))


@bind("s_03_provider_areas", "SELECT n_nationkey, 'POLYGON((' || concat_ws(',', w || ' ' || s, e || ' ' || s, e || ' ' || n, w || ' ' || n, w || ' ' || s) || '))' AS area FROM (SELECT n_nationkey, -130 + n_nationkey AS w, -120 + n_nationkey AS e, 40 + n_nationkey AS s, 50 + n_nationkey AS n FROM nation)")
def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select("n_nationkey").collect()  # reviewed boxes, a few dozen
    return spark.createDataFrame([(k, readers.provider_area(Box(40 + k, 50 + k, -130 + k, -120 + k))) for (k,) in rows], "n_nationkey int, area string")


@bind("s_05_feed_items", "SELECT n_nationkey::BIGINT AS id, n_name AS name FROM nation")
def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A current feed in one of its shapes, landed as a table."""
    items = [{"id": r["n_nationkey"], "name": r["n_name"]} for r in table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()]
    found = readers.feed_items(json.dumps({"count": len(items), "data": items}))
    return spark.createDataFrame([(x["id"], x["name"]) for x in found], "id long, name string")


@bind("s_11_repeated_ids", "SELECT o_custkey AS id, count(*) AS count FROM orders GROUP BY 1 HAVING count(*) > 1")
def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.repeated_ids(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")), "id")


@bind("s_12_repeated_composite_ids", "SELECT lower(trim(c_mktsegment)) AS segment, CAST(c_nationkey AS VARCHAR) AS nation, count(*) AS count FROM customer GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit(" "), F.upper("c_mktsegment")).alias("segment"), F.col("c_nationkey").alias("nation"))
    return readers.repeated_ids(rows, "segment", "nation", fold=True)


@bind("s_02_unexpected_data_sets", "SELECT event_type, count(*) AS count FROM events WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY 1")
def unexpected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.unexpected(table(spark, sf_dir, "events"), "event_type", ["view", "click", "purchase"])


@bind("s_23_universe", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS cell FROM orders")
def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.universe_cells(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("hex_id")).distinct(), valid=r"\d+")


@bind("z_16_to_schema", "SELECT CAST(event_id AS VARCHAR) AS record_id, event_type AS source, CAST(NULL AS VARCHAR) AS species FROM events")
def to_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("record_id"), F.col("event_type").alias("source"), "props")
    return readers.to_schema(rows, readers.SOURCE_RECORD).select("record_id", "source", "species")
