"""Parsing, normalising, filtering and building timelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronomark.functions.classes import pixel_row
from chronomark.functions.time import clamp, format_clock, format_range, key_start, parse_seconds
from chronomark.operators.timeline import first_by, top_k
from chronomark.plans._base import dec, query
from chronomark.sources.testdata import DURATION, EMOTIONS, SEG_SQL, TL_SQL, segments, table, timeline

_NOTATIONS = "CASE l_linenumber % 5 WHEN 0 THEN CAST(l_orderkey % 90 AS VARCHAR) || 's' WHEN 1 THEN CAST(l_orderkey % 90 AS VARCHAR) || '-' || CAST(l_orderkey % 90 + 1 AS VARCHAR) || 's' WHEN 2 THEN CAST(l_orderkey % 60 AS VARCHAR) || ':' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') WHEN 3 THEN 'x' ELSE '-2' END"


def _notation() -> F.Column:
    k, n = (F.col("l_orderkey") % 90).cast("string"), F.col("l_linenumber")
    return (
        F.when(n % 5 == 0, F.concat(k, F.lit("s"))).when(n % 5 == 1, F.concat(k, F.lit("-"), (F.col("l_orderkey") % 90 + 1).cast("string"), F.lit("s")))
        .when(n % 5 == 2, F.concat((F.col("l_orderkey") % 60).cast("string"), F.lit(":"), F.lpad(n.cast("string"), 2, "0"))).when(n % 5 == 3, "x").otherwise("-2")
    )


@query("prj_parse_ts", f"""WITH x AS (SELECT l_orderkey, l_linenumber, {_NOTATIONS} AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, s AS notation, CAST(CASE WHEN s = 'x' THEN NULL WHEN s LIKE '%:%' THEN CAST(split_part(s, ':', 1) AS DOUBLE) * 60 + CAST(split_part(s, ':', 2) AS DOUBLE) WHEN s = '-2' THEN 0 ELSE CAST(split_part(replace(s, 's', ''), '-', 1) AS DOUBLE) END AS DECIMAL(18,6)) AS seconds FROM x""")
def prj_parse_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", _notation().alias("notation"))
    return x.withColumn("seconds", dec(parse_seconds(F.col("notation"))))


@query("prj_format_ts", f"WITH {TL_SQL} SELECT video_id, seq, CAST(CAST(floor(t) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(floor(t) AS BIGINT) + 1 AS VARCHAR) || 's' AS range, CAST(CAST(floor(t * 60) AS BIGINT) // 60 AS VARCHAR) || ':' || lpad(CAST(CAST(floor(t * 60) AS BIGINT) % 60 AS VARCHAR), 2, '0') AS clock FROM tl")
def prj_format_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).select("video_id", "seq", format_range(F.col("t"), F.floor("t") + 1).alias("range"), format_clock(F.col("t") * 60).alias("clock"))


@query("prj_key_start", "SELECT DISTINCT k AS key, try_cast(CASE WHEN regexp_full_match(split_part(k, '-', 1), '[0-9]+') THEN split_part(k, '-', 1) END AS INTEGER) AS start_or_null, CAST(coalesce(floor(try_cast(split_part(k, '-', 1) AS DOUBLE)), 0) AS INTEGER) AS start_or_zero FROM (SELECT CASE l_linenumber % 3 WHEN 0 THEN CAST(l_linenumber AS VARCHAR) || '-9s' WHEN 1 THEN CAST(l_linenumber AS VARCHAR) || '.5-9s' ELSE 'bad' END AS k FROM lineitem)")
def prj_key_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    key = F.when(n % 3 == 0, F.concat(n.cast("string"), F.lit("-9s"))).when(n % 3 == 1, F.concat(n.cast("string"), F.lit(".5-9s"))).otherwise("bad")
    return table(spark, sf_dir, "lineitem").select(key.alias("key")).distinct().select("key", key_start(F.col("key")).alias("start_or_null"), key_start(F.col("key"), True).alias("start_or_zero"))


@query("prj_key_contains", f"WITH {TL_SQL} SELECT video_id, seq FROM tl WHERE 3 <= floor(t) AND floor(t) < 7")
def prj_key_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).where("3 <= floor(t) and floor(t) < 7").select("video_id", "seq")


@query("prj_range_valid", f"WITH {SEG_SQL}, r AS (SELECT video_id, seq, start_s + (seq % 4) * 10 AS a, end_s AS b FROM seg) SELECT video_id, seq, CAST(CASE WHEN a <= b THEN a END AS DECIMAL(18,4)) AS start_s, CAST(CASE WHEN a <= b THEN least(b, 60) END AS DECIMAL(18,4)) AS end_s FROM r")
def prj_range_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = segments(spark, sf_dir).select("video_id", "seq", (F.col("start_s") + (F.col("seq") % 4) * 10).alias("a"), F.col("end_s").alias("b"))
    ok = F.col("a") <= F.col("b")
    return r.select("video_id", "seq", dec(F.when(ok, F.col("a")), 4).alias("start_s"), dec(F.when(ok, F.least("b", F.lit(60.0))), 4).alias("end_s"))


@query("prj_ts_list_norm", f"WITH {TL_SQL} SELECT video_id, array_to_string(list(CAST(CAST(least(round(t * 1000), 20000) AS BIGINT) AS VARCHAR) ORDER BY t, seq), ',') AS times_ms FROM tl WHERE entry_type = 'scene_change' GROUP BY video_id")
def prj_ts_list_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = timeline(spark, sf_dir).where("entry_type = 'scene_change'").groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("t", "seq"))).alias("x"))
    return x.select("video_id", F.array_join(F.transform("x", lambda v: F.least(F.round(v["t"] * 1000), F.lit(20000.0)).cast("long").cast("string")), ",").alias("times_ms"))


@query("prj_annotation_ts", "SELECT l_orderkey, l_linenumber, CAST(coalesce(CASE WHEN l_linenumber % 3 = 0 THEN l_quantity END, CASE WHEN l_linenumber % 3 = 1 THEN l_tax END, l_orderkey / coalesce(nullif(l_linenumber * 10, 20), 30.0)) AS DECIMAL(18,4)) AS at_s FROM lineitem")
def prj_annotation_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    at = F.coalesce(F.when(n % 3 == 0, F.col("l_quantity")), F.when(n % 3 == 1, F.col("l_tax")), F.col("l_orderkey") / F.coalesce(F.nullif(n * 10, F.lit(20)).cast("double"), F.lit(30.0)))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", dec(at, 4).alias("at_s"))


@query("prj_position", "SELECT l_orderkey, l_linenumber, CASE WHEN y < 0.33 THEN 'top' WHEN y > 0.67 THEN 'bottom' ELSE 'middle' END || '-' || CASE WHEN x < 0.33 THEN 'left' WHEN x > 0.67 THEN 'right' ELSE 'center' END AS position FROM (SELECT l_orderkey, l_linenumber, (l_quantity - 1) / 49 AS x, l_discount * 10 AS y FROM lineitem)")
def prj_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = lambda c, a, b, m: F.when(c < 0.33, a).when(c > 0.67, b).otherwise(m)
    x, y = (F.col("l_quantity") - 1) / 49, F.col("l_discount") * 10
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(third(y, "top", "bottom", "middle"), F.lit("-"), third(x, "left", "right", "center")).alias("position"))


@query("prj_vpos_px", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity * 12 > 400 THEN 'bottom' WHEN l_quantity * 12 < 200 THEN 'top' ELSE 'center' END AS place FROM lineitem")
def prj_vpos_px(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", pixel_row(F.col("l_quantity") * 12).alias("place"))


@query("prj_poly_bbox", "SELECT vec_id, CAST(list_min(e[1:4]) AS DECIMAL(18,6)) AS x, CAST(list_min(e[5:8]) AS DECIMAL(18,6)) AS y, CAST(CAST(list_max(e[1:4]) AS DOUBLE) - list_min(e[1:4]) AS DECIMAL(18,6)) AS w, CAST(CAST(list_max(e[5:8]) AS DOUBLE) - list_min(e[5:8]) AS DECIMAL(18,6)) AS h FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)")
def prj_poly_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    xs, ys = F.slice("e", 1, 4), F.slice("e", 5, 4)
    return e.select("vec_id", dec(F.array_min(xs)).alias("x"), dec(F.array_min(ys)).alias("y"), dec(F.array_max(xs) - F.array_min(xs)).alias("w"), dec(F.array_max(ys) - F.array_min(ys)).alias("h"))


@query("prj_ltrb_norm", "SELECT l_orderkey, l_linenumber, CAST(l_quantity / 576 AS DECIMAL(18,6)) AS l, CAST(l_linenumber / 1024.0 AS DECIMAL(18,6)) AS t, CAST((l_quantity + 50) / 576 AS DECIMAL(18,6)) AS r, CAST((l_linenumber + 80) / 1024.0 AS DECIMAL(18,6)) AS b FROM lineitem")
def prj_ltrb_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", dec(q / 576).alias("l"), dec(n / 1024.0).alias("t"), dec((q + 50) / 576).alias("r"), dec((n + 80) / 1024.0).alias("b"))


@query("prj_key_coalesce", "SELECT event_id, coalesce(props ->> '$.class', props ->> '$.k', 'unknown') AS class_name FROM events")
def prj_key_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = lambda k: F.get_json_object("props", k)
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(j("$.class"), j("$.k"), F.lit("unknown")).alias("class_name"))


@query("prj_nested_or_flat", "SELECT event_id, CAST(coalesce(props ->> '$.data.k', props ->> '$.k') AS BIGINT) AS k FROM events")
def prj_nested_or_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = lambda k: F.get_json_object("props", k)
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(j("$.data.k"), j("$.k")).cast("long").alias("k"))


@query("prj_emotion_remap", f"WITH {TL_SQL} SELECT video_id, seq, (['" + "', '".join(EMOTIONS) + "'])[label + 1] AS emotion FROM tl WHERE entry_type = 'emotion'")
def prj_emotion_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, EMOTIONS))
    return timeline(spark, sf_dir).where("entry_type = 'emotion'").select("video_id", "seq", F.element_at(names, (F.col("label") + 1).cast("int")).alias("emotion"))


@query("prj_type_remap", "SELECT event_id, CASE event_type WHEN 'click' THEN 'pointing' WHEN 'view' THEN 'open_palm' ELSE lower(event_type) END AS gesture FROM events")
def prj_type_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.create_map(F.lit("click"), F.lit("pointing"), F.lit("view"), F.lit("open_palm"))
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(F.element_at(names, F.col("event_type")), F.lower("event_type")).alias("gesture"))


@query("flt_conf_gesture", f"WITH {TL_SQL} SELECT video_id, seq, label FROM tl WHERE entry_type = 'gesture' AND conf > 0.5")
def flt_conf_gesture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).where("entry_type = 'gesture' and conf > 0.5").select("video_id", "seq", "label")


@query("flt_face_score", f"WITH {TL_SQL} SELECT video_id, seq, CASE WHEN conf > 0.5 THEN 'face' ELSE 'no_face' END AS face FROM tl WHERE entry_type = 'object'")
def flt_face_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).where("entry_type = 'object'").select("video_id", "seq", F.when(F.col("conf") > 0.5, "face").otherwise("no_face").alias("face"))


@query("flt_valid_segment", f"WITH {SEG_SQL} SELECT video_id, seq FROM seg WHERE text IS NOT NULL AND trim(text) <> '' AND end_s > start_s")
def flt_valid_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).where("text is not null and trim(text) <> '' and end_s > start_s").select("video_id", "seq")


@query("flt_sticker_shape", """WITH s AS (SELECT l_orderkey, l_linenumber, l_quantity * 10 AS w, 100 + l_linenumber * 20 AS h FROM lineitem), k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS r FROM s WHERE w * h > 200 AND w * h < 15000 AND w / h > 0.3 AND w / h < 3)
SELECT l_orderkey, l_linenumber FROM k WHERE r <= 5""")
def flt_sticker_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 10).alias("w"), (100 + F.col("l_linenumber") * 20).alias("h"))
    kept = s.where("w * h > 200 and w * h < 15000 and w / h > 0.3 and w / h < 3")
    return top_k(kept, 5, ["l_linenumber"], ["l_orderkey"]).select("l_orderkey", "l_linenumber")


@query("flt_by_type", f"WITH {TL_SQL} SELECT video_id, seq, CAST(t AS DECIMAL(18,6)) AS t FROM tl WHERE entry_type = 'emotion'")
def flt_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).where("entry_type = 'emotion'").select("video_id", "seq", dec("t").alias("t"))


@query("flt_range_overlap", f"WITH {SEG_SQL} SELECT video_id, seq FROM seg WHERE end_s >= 5 AND start_s <= 20")
def flt_range_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).where("end_s >= 5 and start_s <= 20").select("video_id", "seq")


@query("flt_at_time", f"WITH {SEG_SQL} SELECT video_id, seq FROM seg WHERE (start_s <= 12 AND 12 < end_s) OR (start_s = end_s AND abs(start_s - 12) < 0.001)")
def flt_at_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).where("(start_s <= 12 and 12 < end_s) or (start_s = end_s and abs(start_s - 12) < 0.001)").select("video_id", "seq")


@query("flt_overlaps", f"WITH {SEG_SQL} SELECT a.video_id, a.seq, b.seq AS other FROM seg a JOIN seg b ON a.video_id = b.video_id AND a.seq < b.seq AND a.start_s < b.end_s + 1 AND b.start_s < a.end_s + 1")
def flt_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of segments that overlap or nearly do. A segment is dealt to the whole seconds that it nearly covers; a pair meets
    in each second that both have and is kept in the first of them."""
    a = segments(spark, sf_dir).select("video_id", "seq", "start_s", "end_s", F.explode(F.sequence(F.floor("start_s"), F.floor("end_s") + 1)).alias("sec"))
    b = a.toDF("video_id", "other", "bs", "be", "sec")
    near = a.join(b, ["video_id", "sec"]).where("seq < other and start_s < be + 1 and bs < end_s + 1 and sec = greatest(floor(start_s), floor(bs))")
    return near.select("video_id", "seq", "other")


@query("flt_keyword_any", "SELECT doc_id FROM documents WHERE regexp_matches(lower(text), 'license|rights reserved|token')")
def flt_keyword_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(F.lower("text").rlike("license|rights reserved|token")).select("doc_id")


@query("flt_bbox_valid", "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_quantity / 40 BETWEEN 0 AND 1 AND l_discount BETWEEN 0 AND 1 THEN l_quantity / 40 * l_discount * 100 ELSE 0 END AS DECIMAL(18,6)) AS area FROM lineitem")
def flt_bbox_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = F.col("l_quantity") / 40, F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", dec(F.when(w.between(0, 1) & h.between(0, 1), w * h * 100).otherwise(0.0)).alias("area"))


@query("flt_short_lists", f"WITH {TL_SQL} SELECT video_id, array_to_string(list(CAST(seq AS VARCHAR) ORDER BY t, seq)[1:10], ',') AS first_seqs FROM tl GROUP BY video_id")
def flt_short_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = top_k(timeline(spark, sf_dir), 10, ["t", "seq"])
    lists = first.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("rank", "seq"))).alias("x"))
    return lists.select("video_id", F.array_join(F.transform("x", lambda v: v["seq"].cast("string")), ",").alias("first_seqs"))


@query("set_union_detectors", f"""WITH {TL_SQL}, {SEG_SQL} SELECT video_id, seq, CAST(t AS DECIMAL(18,4)) AS start_s, entry_type FROM tl UNION ALL SELECT video_id, seq, CAST(start_s AS DECIMAL(18,4)), 'speech' FROM seg""")
def set_union_detectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = timeline(spark, sf_dir).select("video_id", "seq", dec("t", 4).alias("start_s"), "entry_type")
    return a.unionByName(segments(spark, sf_dir).select("video_id", "seq", dec("start_s", 4).alias("start_s"), F.lit("speech").alias("entry_type")))


def _extent(name: str, kind: str, seconds: str) -> None:
    """Entries of a kind as intervals that last a fixed or derived time."""

    @query(name, f"WITH {TL_SQL} SELECT video_id, seq, CAST(t AS DECIMAL(18,6)) AS start_s, CAST(t + {seconds} AS DECIMAL(18,6)) AS end_s FROM tl WHERE entry_type = '{kind}'")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return timeline(spark, sf_dir).where(F.col("entry_type") == kind).select("video_id", "seq", dec("t").alias("start_s"), dec(F.col("t") + F.expr(seconds)).alias("end_s"))


_extent("tl_gesture", "gesture", "0.5")
_extent("tl_sticker", "object", "2")
_extent("tl_emotion", "emotion", "1")
_extent("tl_object", "object", "0")


@query("tl_text", "SELECT doc_id, CAST(greatest(1, length(text) * 0.1) AS DECIMAL(18,4)) AS lasts_s FROM documents")
def tl_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", dec(F.greatest(F.lit(1.0), F.char_length("text") * 0.1), 4).alias("lasts_s"))


@query("tl_speech", f"WITH {SEG_SQL} SELECT video_id, seq, CAST(start_s AS DECIMAL(18,4)) AS start_s, CAST(end_s AS DECIMAL(18,4)) AS end_s FROM seg")
def tl_speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).select("video_id", "seq", dec("start_s", 4).alias("start_s"), dec("end_s", 4).alias("end_s"))


@query("tl_clamp_sort", f"WITH {SEG_SQL} SELECT video_id, seq, CAST(least(start_s, 60) AS DECIMAL(18,4)) AS start_s, CAST(least(end_s, 60) AS DECIMAL(18,4)) AS end_s, row_number() OVER (PARTITION BY video_id ORDER BY least(start_s, 60), seq) AS place FROM seg")
def tl_clamp_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = segments(spark, sf_dir).select("video_id", "seq", clamp(F.col("start_s"), 0.0, 60.0).alias("a"), clamp(F.col("end_s"), 0.0, 60.0).alias("b"))
    place = F.row_number().over(Window.partitionBy("video_id").orderBy("a", "seq")).cast("long")
    return c.select("video_id", "seq", dec("a", 4).alias("start_s"), dec("b", 4).alias("end_s"), place.alias("place"))


@query("tl_default_duration", f"WITH {SEG_SQL} SELECT video_id, CAST(CASE WHEN max(end_s) > 0 THEN max(end_s) ELSE 60 END AS DECIMAL(18,4)) AS duration_s FROM seg GROUP BY video_id")
def tl_default_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.max("end_s")
    return segments(spark, sf_dir).groupBy("video_id").agg(dec(F.when(m > 0, m).otherwise(60.0), 4).alias("duration_s"))


@query("tl_validate", f"WITH {SEG_SQL}, l AS (SELECT *, lag(start_s) OVER (PARTITION BY video_id ORDER BY seq) AS p FROM seg) SELECT video_id, count(*) FILTER (p > start_s) AS disordered, count(*) FILTER (end_s < start_s) AS reversed, count(*) FILTER (start_s > 60) AS late FROM l GROUP BY video_id")
def tl_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = segments(spark, sf_dir).withColumn("p", F.lag("start_s").over(Window.partitionBy("video_id").orderBy("seq")))
    n = lambda c: F.count_if(F.coalesce(F.expr(c), F.lit(False)))
    return l.groupBy("video_id").agg(n("p > start_s").alias("disordered"), n("end_s < start_s").alias("reversed"), n("start_s > 60").alias("late"))


@query("map_upsert_last", f"WITH {TL_SQL} SELECT video_id, sec, seq, label FROM (SELECT video_id, CAST(floor(t) AS BIGINT) AS sec, seq, label, row_number() OVER (PARTITION BY video_id, floor(t) ORDER BY t DESC, seq DESC) AS r FROM tl WHERE entry_type = 'text') WHERE r = 1")
def map_upsert_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.max(F.struct("t", "seq", "label")).alias("x")
    return timeline(spark, sf_dir).where("entry_type = 'text'").groupBy("video_id", F.floor("t").cast("long").alias("sec")).agg(last).select("video_id", "sec", "x.seq", "x.label")


@query("map_object_counts", f"WITH {TL_SQL} SELECT video_id, CAST(floor(t) AS BIGINT) AS sec, count(*) AS total, count(DISTINCT label) AS classes FROM tl WHERE entry_type = 'object' GROUP BY ALL")
def map_object_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).where("entry_type = 'object'").groupBy("video_id", F.floor("t").cast("long").alias("sec")).agg(F.count("*").alias("total"), F.countDistinct("label").alias("classes"))


@query("agg_object_distinct_class", f"WITH {TL_SQL} SELECT video_id, CAST(floor(t) AS BIGINT) AS sec, count(DISTINCT label) AS classes FROM tl WHERE entry_type = 'object' GROUP BY ALL")
def agg_object_distinct_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_object_counts(spark, sf_dir).drop("total")


@query("map_gesture_set", f"WITH {TL_SQL} SELECT video_id, CAST(floor(t) AS BIGINT) AS sec, array_to_string(list_sort(list(DISTINCT CAST(label AS VARCHAR))), ',') AS gestures, CAST(max(conf) AS DECIMAL(18,6)) AS conf FROM tl WHERE entry_type = 'gesture' GROUP BY ALL")
def map_gesture_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).where("entry_type = 'gesture'").groupBy("video_id", F.floor("t").cast("long").alias("sec")).agg(F.array_join(F.array_sort(F.collect_set(F.col("label").cast("string"))), ",").alias("gestures"), dec(F.max("conf")).alias("conf"))


@query("map_scene_split", f"WITH {TL_SQL} SELECT video_id, seq, CAST(floor(t) + (row_number() OVER (PARTITION BY video_id, floor(t) ORDER BY t, seq) - 1) / 1000.0 AS DECIMAL(18,6)) AS key FROM tl WHERE entry_type = 'scene_change'")
def map_scene_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("video_id", "sec").orderBy("t", "seq")
    s = timeline(spark, sf_dir).where("entry_type = 'scene_change'").withColumn("sec", F.floor("t"))
    return s.select("video_id", "seq", dec(F.col("sec") + (F.row_number().over(w) - 1) / 1000.0).alias("key"))


@query("map_scene_intervals", f"""WITH {TL_SQL}, c AS (SELECT video_id, t, seq FROM tl WHERE entry_type = 'scene_change'), a AS (SELECT video_id, coalesce(lag(t) OVER (PARTITION BY video_id ORDER BY t, seq), 0) AS s, t AS e FROM c UNION ALL SELECT video_id, max(t), {DURATION} FROM c GROUP BY video_id)
SELECT video_id, CAST(s AS DECIMAL(18,6)) AS start_s, CAST(e AS DECIMAL(18,6)) AS end_s FROM a""")
def map_scene_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = timeline(spark, sf_dir).where("entry_type = 'scene_change'")
    a = c.select("video_id", F.lag("t", 1, 0.0).over(Window.partitionBy("video_id").orderBy("t", "seq")).alias("s"), F.col("t").alias("e"))
    tail = c.groupBy("video_id").agg(F.max("t").alias("s")).withColumn("e", F.lit(float(DURATION)))
    return a.unionByName(tail).select("video_id", dec("s").alias("start_s"), dec("e").alias("end_s"))


@query("tl_prompt_group", f"WITH {TL_SQL} SELECT video_id, CAST(CAST(floor(t) AS BIGINT) AS VARCHAR) || 's' AS key, count(*) AS entries, CAST(sum(label) AS BIGINT) AS labels FROM tl GROUP BY ALL")
def tl_prompt_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).groupBy("video_id", F.concat(F.floor("t").cast("string"), F.lit("s")).alias("key")).agg(F.count("*").alias("entries"), F.sum("label").alias("labels"))


@query("tl_dedup_text", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def tl_dedup_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First occurrence of each text of a source, grouped by a wide hash so that texts are not shuffled."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("h"))
    return d.groupBy("source", "h").agg(F.min("doc_id").alias("doc_id")).select("doc_id")


@query("tl_dedup_sticker", "SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, CAST(l_quantity AS BIGINT) % 5 ORDER BY l_linenumber) AS r FROM lineitem) WHERE r = 1")
def tl_dedup_sticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").withColumn("cell", F.col("l_quantity").cast("long") % 5)
    return first_by(x, ["l_orderkey", "cell"], ["l_linenumber"]).select("l_orderkey", "l_linenumber")


@query("set_merge_primary", f"WITH {TL_SQL} SELECT video_id, entry_type, seq FROM (SELECT *, row_number() OVER (PARTITION BY video_id, entry_type ORDER BY CASE WHEN conf > 0.3 THEN 0 ELSE 1 END, t, seq) AS r FROM tl) WHERE r = 1")
def set_merge_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.min(F.struct((F.col("conf") <= 0.3).alias("failed"), "t", "seq"))["seq"]
    return timeline(spark, sf_dir).groupBy("video_id", "entry_type").agg(best.alias("seq"))


@query("set_merge_pair", f"WITH {TL_SQL}, {SEG_SQL}, u AS (SELECT video_id, t AS e FROM tl UNION ALL SELECT video_id, end_s FROM seg) SELECT video_id, count(*) AS entries, CAST(max(e) AS DECIMAL(18,4)) AS duration_s FROM u GROUP BY video_id")
def set_merge_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = timeline(spark, sf_dir).select("video_id", F.col("t").alias("e")).unionByName(segments(spark, sf_dir).select("video_id", F.col("end_s").alias("e")))
    return u.groupBy("video_id").agg(F.count("*").alias("entries"), dec(F.max("e"), 4).alias("duration_s"))


@query("set_key_diff", f"WITH {TL_SQL}, a AS (SELECT DISTINCT video_id, label FROM tl WHERE entry_type = 'object'), b AS (SELECT DISTINCT video_id, label FROM tl WHERE entry_type = 'emotion') SELECT coalesce(a.video_id, b.video_id) AS video_id, coalesce(a.label, b.label) AS label, CASE WHEN b.label IS NULL THEN 'only_a' WHEN a.label IS NULL THEN 'only_b' ELSE 'both' END AS side FROM a FULL JOIN b ON a.video_id = b.video_id AND a.label = b.label")
def set_key_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    tl = timeline(spark, sf_dir).where("entry_type in ('object', 'emotion')")
    has = lambda k: F.bool_or(F.col("entry_type") == k)
    return tl.groupBy("video_id", "label").agg(F.when(~has("emotion"), "only_a").when(~has("object"), "only_b").otherwise("both").alias("side"))


