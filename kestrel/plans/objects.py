"""Object-listing and message queries over ``objects`` / ``messages`` (from pages
and conversations), including the streaming ingest run to completion."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import objects as O
from kestrel.plans.oracle import MESSAGES, OBJECTS, with_
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources.derived import messages, objects
from kestrel.sources.tables import table
from kestrel.streaming.ingest import message_handler, mirrored, run_object_ingest

_GOOD = MESSAGES + """,
decoded AS (SELECT message_id, body,
                   CASE WHEN json_valid(body) AND json_type(body) = 'OBJECT'
                        THEN json_extract_string(body, '$.path') END AS path FROM messages),
good AS (SELECT message_id, path FROM decoded WHERE path IS NOT NULL AND length(path) > 0),
matched AS (
  SELECT g.message_id, g.path, o.page_id, o.name, o.size, o.updated,
         substr(o.name, length(rtrim(g.path, '/')) + 2) AS relative_path
  FROM good g JOIN objects o ON starts_with(o.name, rtrim(g.path, '/') || '/')
  WHERE o.name <> rtrim(g.path, '/') || '/'),
mir AS (SELECT m.message_id, m.path, m.relative_path, CAST(octet_length(encode(p.html)) AS BIGINT) AS length
        FROM matched m JOIN pages p USING (page_id))"""


def _matched(spark, sf):
    good, _bad = O.decode_messages(messages(spark, sf))
    return O.join_message_prefix(good, objects(spark, sf))


def _contents(spark, sf):
    return table(spark, sf, "pages", "page_id", "html")


def _mirror(spark, sf):
    """(message_id, path, relative_path, length, content)."""
    good, _bad = O.decode_messages(messages(spark, sf))
    dirs = good.select(O.strip_trailing_slash(F.col("path")).alias("_dir")).distinct()
    return O.mirror_of_messages(good, O.mirror_objects(dirs, objects(spark, sf), _contents(spark, sf)))


@query("scan_object_metadata", with_(OBJECTS) + "SELECT * FROM objects")
def q_scan_object_metadata(spark, sf):
    return objects(spark, sf)


@query("scan_object_listing")
def q_scan_object_listing(spark, sf):
    """Every file of the input folder with its name and size (SQL over the tables cannot see files; the
    tests hold it against the file system)."""
    return O.list_files(spark, sf, "*.parquet").select("name", F.col("length").alias("size"))


@query("object_exists", with_(OBJECTS) + """,
req AS (SELECT name FROM objects UNION ALL SELECT name || '.bak' FROM objects)
SELECT r.name, EXISTS (SELECT 1 FROM objects o WHERE o.name = r.name) AS "exists" FROM req r""")
def q_object_exists(spark, sf):
    o = objects(spark, sf)
    # every object name, and the same name with a suffix that does not exist
    req = o.select("name").unionByName(o.select(F.concat("name", F.lit(".bak")).alias("name")))
    return O.object_exists(req, o)


@query("filter_prefix", with_(OBJECTS) + """,
p AS (SELECT min(split_part(name, '/', 1)) || '/' AS p FROM objects)
SELECT name, substr(name, length(p) + 1) AS relative_path FROM objects, p
WHERE starts_with(name, p) AND name <> p""")
def q_filter_prefix(spark, sf):
    """P5 for the first directory of the listing, given without its slash."""
    o = objects(spark, sf).select("name")
    return O.filter_prefix(o, o.agg(F.min(F.split_part("name", F.lit("/"), F.lit(1)))).first()[0])


@query("resolve_object", with_(OBJECTS) + """,
p AS (SELECT min(split_part(name, '/', 1)) || '/' AS p FROM objects),
newest AS (SELECT name, updated FROM objects, p WHERE starts_with(name, p) AND updated IS NOT NULL
           ORDER BY updated DESC, name LIMIT 1)
SELECT 'newest' AS how, name, updated FROM newest
UNION ALL SELECT 'explicit', name, updated FROM objects WHERE name = (SELECT max(name) FROM objects)""")
def q_resolve_object(spark, sf):
    """A10: the newest object under a prefix; an object named explicitly wins over it."""
    o = objects(spark, sf)
    ends = o.agg(F.min(F.split_part("name", F.lit("/"), F.lit(1))), F.max("name")).first()
    newest = O.resolve_object(o, f"{ends[0]}/")
    named = O.resolve_object(o, f"{ends[0]}/", explicit=ends[1])
    return newest.withColumn("how", F.lit("newest")).unionByName(named.withColumn("how", F.lit("explicit")))


@query("filter_prefix_dir", with_(OBJECTS) + """,
tops AS (SELECT DISTINCT split_part(name, '/', 1) AS top FROM objects)
SELECT t.top, o.name, substr(o.name, length(t.top) + 2) AS relative_path
FROM tops t JOIN objects o ON starts_with(o.name, t.top || '/') AND o.name <> t.top || '/'""")
def q_filter_prefix_dir(spark, sf):
    """P5 for every top-level directory: '/' appended, directory marker skipped."""
    o = objects(spark, sf)
    tops = o.select(F.split_part("name", F.lit("/"), F.lit(1)).alias("path")).distinct()
    return O.join_message_prefix(tops, o.select("name")).select(
        F.col("path").alias("top"), "name", "relative_path")


@query("quarantine_malformed", with_(_GOOD) + """
SELECT message_id, body, 'malformed message' AS error FROM decoded WHERE path IS NULL OR length(path) = 0""")
def q_quarantine_malformed(spark, sf):
    _good, bad = O.decode_messages(messages(spark, sf))
    return bad.select("message_id", "body", "error")


@query("stream_messages", with_(_GOOD) + "SELECT message_id, path FROM good")
def q_stream_messages(spark, sf):
    """Messages as files, read as a stream, decoded and appended to a table."""
    base = scratch_path(spark, "messages")
    messages(spark, sf).write.json(f"{base}/inbox")
    stream = spark.readStream.schema("message_id string, body string").json(f"{base}/inbox")
    good, _ = O.decode_messages(stream)
    (good.select("message_id", "path").writeStream.format("parquet").option("path", f"{base}/good")
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema("message_id string, path string").parquet(f"{base}/good")


@query("join_message_prefix", with_(_GOOD) + "SELECT message_id, path, name, relative_path FROM matched")
def q_join_message_prefix(spark, sf):
    return _matched(spark, sf).select("message_id", "path", "name", "relative_path")


@query("sink_mirror_prefix", with_(_GOOD) + "SELECT * FROM mir")
def q_sink_mirror_prefix(spark, sf):
    """K7: the objects of each directory written once (content included) beside the messages, read back
    without content."""
    path = scratch_path(spark, "mirror")
    good, _bad = O.decode_messages(messages(spark, sf))
    dirs = good.select(O.strip_trailing_slash(F.col("path")).alias("_dir")).distinct()
    O.mirror_objects(dirs, objects(spark, sf), _contents(spark, sf)).write.mode("overwrite").parquet(path)
    return O.mirror_of_messages(good, spark.read.parquet(path).drop("content"))


@query("latest_object", with_(_GOOD) + """
SELECT message_id, name, updated FROM (
  SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY updated DESC, name) AS rk
  FROM matched WHERE updated IS NOT NULL) WHERE rk = 1""")
def q_latest_object(spark, sf):
    return O.latest_object(_matched(spark, sf), ["message_id"]).select("message_id", "name", "updated")


@query("directory_listing", with_(_GOOD) + """,
files AS (SELECT message_id, relative_path AS entry, 'FILE' AS kind, length AS size FROM mir),
dirs AS (SELECT DISTINCT message_id, array_to_string(list_slice(parts, 1, i), '/') || '/' AS entry
         FROM (SELECT message_id, string_split(relative_path, '/') AS parts,
                      unnest(generate_series(1, len(string_split(relative_path, '/')) - 1)) AS i
               FROM mir WHERE contains(relative_path, '/')))
SELECT message_id, entry, kind, size FROM files
UNION ALL SELECT message_id, entry, 'DIR', CAST(NULL AS BIGINT) FROM dirs""")
def q_directory_listing(spark, sf):
    m = _mirror(spark, sf).select("message_id", "relative_path", F.col("length").alias("size"))
    return O.directory_listing(m, ["message_id"])


@query("top_level_entries", with_(_GOOD) + """
SELECT message_id, split_part(relative_path, '/', 1) AS entry,
       CASE WHEN max(CASE WHEN contains(relative_path, '/') THEN 1 ELSE 0 END) = 1 THEN 'DIR' ELSE 'FILE' END AS kind,
       CASE WHEN max(CASE WHEN contains(relative_path, '/') THEN 1 ELSE 0 END) = 1 THEN NULL
            ELSE CAST(sum(CASE WHEN NOT contains(relative_path, '/') THEN length END) AS BIGINT) END AS size
FROM mir GROUP BY 1, 2""")
def q_top_level_entries(spark, sf):
    m = _mirror(spark, sf).select("message_id", "relative_path", F.col("length").alias("size"))
    return O.top_level_entries(m, ["message_id"])


@query("str_path_ops", with_(OBJECTS) + """
SELECT name,
       CASE WHEN ends_with(name, '/') THEN name ELSE name || '/' END AS dir_form,
       regexp_replace(name, '/+$', '') AS no_slash,
       string_split(regexp_replace(name, '/+$', ''), '/')[-1] AS base,
       CASE WHEN regexp_extract(string_split(regexp_replace(name, '/+$', ''), '/')[-1], '(\\.[^./]+)$', 1) = '' THEN '.tmp'
            ELSE regexp_extract(string_split(regexp_replace(name, '/+$', ''), '/')[-1], '(\\.[^./]+)$', 1) END AS ext,
       string_split(regexp_replace(name, '/+$', ''), '/')[-1] || '_' || strftime(created, '%Y%m%d_%H%M%S') AS stamped,
       'store://' || bucket || '/' || name AS uri
FROM objects""")
def q_str_path_ops(spark, sf):
    o = objects(spark, sf)
    n = F.col("name")
    return o.select("name", O.ensure_trailing_slash(n).alias("dir_form"), O.strip_trailing_slash(n).alias("no_slash"),
                    O.base_name(n).alias("base"), O.extension(n).alias("ext"),
                    F.concat(O.base_name(n), F.lit("_"), F.date_format("created", "yyyyMMdd_HHmmss")).alias("stamped"),
                    F.concat(F.lit("store://"), F.col("bucket"), F.lit("/"), n).alias("uri"))


@query("stream_object_ingest", with_(_GOOD) + "SELECT * FROM mir")
def q_stream_object_ingest(spark, sf):
    """Messages written as files, consumed by a file stream with availableNow; each batch reads the
    listing's partitions that it names and writes its mirror; the result is the mirror read back."""
    base = scratch_path(spark, "ingest")
    messages(spark, sf).repartition(4).write.mode("overwrite").json(f"{base}/inbox")
    listing = O.write_listing(objects(spark, sf), _contents(spark, sf), f"{base}/objects")
    out = run_object_ingest(spark, f"{base}/inbox", listing, f"{base}/out", f"{base}/checkpoint", max_files_per_trigger=2)
    # a restart from the same checkpoint finds nothing new and adds nothing
    run_object_ingest(spark, f"{base}/inbox", listing, f"{base}/out", f"{base}/checkpoint")
    return mirrored(spark, out["mirror"]).drop("content")


@query("message_handler", with_(_GOOD) + "SELECT * FROM mir")
def q_message_handler(spark, sf):
    """The per-batch user callback applied to one batch of messages."""
    base = scratch_path(spark, "handler")
    listing = O.write_listing(objects(spark, sf), _contents(spark, sf), f"{base}/objects")
    handle = message_handler(listing, f"{base}/mirror", f"{base}/dead")
    handle(messages(spark, sf), 0)
    handle(messages(spark, sf), 0)          # a retried batch replaces its own output
    return mirrored(spark, f"{base}/mirror").drop("content")
