"""Object listings and message-driven prefix mirroring.

The prefix join (an object belongs to a message when its name starts with
``path/``) is a theta join; it is planned here as an equi-join on the object's
ancestor directories, so it never becomes a nested loop: each object name
``a/b/c`` is exploded into ``a`` and ``a/b``, and a message path matches one of
those exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.fixed import DEFAULT_EXTENSION

MESSAGE_SCHEMA = "path string"


# ---------------------------------------------------------------- F1 path helpers
def ensure_trailing_slash(c: Column) -> Column:
    return F.when(c.endswith("/"), c).otherwise(F.concat(c, F.lit("/")))


def strip_trailing_slash(c: Column) -> Column:
    return F.regexp_replace(c, "/+$", "")


def base_name(c: Column) -> Column:
    """Last '/' segment of a path (trailing slash ignored)."""
    return F.substring_index(strip_trailing_slash(c), "/", -1)


def extension(c: Column, default: str = DEFAULT_EXTENSION) -> Column:
    """Extension of the last segment including the dot, or ``default``."""
    ext = F.regexp_extract(base_name(c), r"(\.[^./]+)$", 1)
    return F.when(ext == "", F.lit(default)).otherwise(ext)


def ancestors(name: Column) -> Column:
    """All proper ancestor directories of an object name: 'a/b/c' -> ['a', 'a/b']."""
    parts = F.split(name, "/")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                       lambda i: F.array_join(F.slice(parts, 1, i), "/"))


# ---------------------------------------------------------------- S8 / P6 messages
def decode_messages(messages: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(decoded messages with ``path``, dead-letter rows).  A body that is not a
    JSON object with a string ``path`` is routed to the dead letters (nack)."""
    d = messages.withColumn("_m", F.from_json(F.col(body), MESSAGE_SCHEMA))
    ok = F.col("_m.path").isNotNull() & (F.length(F.col("_m.path")) > 0)
    good = d.where(ok).withColumn("path", F.col("_m.path")).drop("_m")
    bad = d.where(~ok | F.col("_m").isNull()).drop("_m").withColumn("error", F.lit("malformed message"))
    return good, bad


# ---------------------------------------------------------------- P5, J2, K7
def filter_prefix(objects: DataFrame, prefix: str, name: str = "name") -> DataFrame:
    """P5: objects under ``prefix`` ('/' appended when absent), without the directory
    marker itself; adds ``relative_path``."""
    p = prefix if prefix.endswith("/") else prefix + "/"
    return (objects.where(F.col(name).startswith(p) & (F.col(name) != p))
                   .withColumn("relative_path", F.substring(F.col(name), len(p) + 1, 1 << 30)))


def match_directories(dirs: DataFrame, objects: DataFrame, name: str = "name", more: list[str] | None = None) -> DataFrame:
    """Objects under each directory of ``dirs`` (distinct values in ``_dir``): every (directory, object) once, with
    ``relative_path``; the directory marker (name == directory + '/') is skipped.  ``more``: further columns that
    both sides have, such as a partition column of the listing."""
    o = objects.withColumn("_dir", F.explode(ancestors(F.col(name))))
    rel = F.expr(f"substring({name}, length(_dir) + 2)")
    return dirs.join(o, ["_dir", *(more or [])]).withColumn("relative_path", rel).where(F.col("relative_path") != "")


def join_message_prefix(messages: DataFrame, objects: DataFrame, path: str = "path",
                        name: str = "name") -> DataFrame:
    """Every (message, object) with object name under ``path + '/'``; adds
    ``relative_path``; the directory marker (name == path + '/') is skipped.

    Objects are matched with the distinct directories; the messages that name a directory are
    attached to its matches afterwards."""
    m = messages.withColumn("_dir", strip_trailing_slash(F.col(path)))
    matched = match_directories(m.select("_dir").distinct(), objects, name)
    return m.join(matched, "_dir").drop("_dir")


def mirror_objects(dirs: DataFrame, objects: DataFrame, content: DataFrame, key: str = "page_id",
                   more: list[str] | None = None) -> DataFrame:
    """K7: what a mirror holds, (dir, relative_path, length, content): each directory's objects once,
    however many messages name it."""
    return match_directories(dirs, objects, more=more).join(content, [key, *(more or [])]).select(
        F.col("_dir").alias("dir"), "relative_path", F.octet_length("html").cast("bigint").alias("length"), F.col("html").alias("content"))


def mirror_of_messages(messages: DataFrame, mirror: DataFrame, path: str = "path") -> DataFrame:
    """The mirrored objects of each message: (message_id, path, and the columns of the mirror but the directory)."""
    m = messages.select("message_id", path, strip_trailing_slash(F.col(path)).alias("dir"))
    return m.join(mirror, "dir").drop("dir")


# ---------------------------------------------------------------- T1: a listing that batches prune
PARTS = 64


def listing_part(name: Column) -> Column:
    """The partition of a top directory (of a name or a path) in a written listing."""
    return F.pmod(F.xxhash64(F.split_part(name, F.lit("/"), F.lit(1))), F.lit(PARTS)).cast("int")


def write_listing(objects: DataFrame, content: DataFrame, path: str, key: str = "page_id", name: str = "name") -> str:
    """The listing and the content as tables partitioned by top directory (hashed, so their number is bounded): a
    batch reads the partitions of the directories that it names."""
    parted = objects.withColumn("part", listing_part(F.col(name)))
    parted.write.mode("overwrite").partitionBy("part").parquet(f"{path}/listing")
    content.join(parted.select(key, "part"), key).write.mode("overwrite").partitionBy("part").parquet(f"{path}/content")
    return path


# ---------------------------------------------------------------- A10-A12
def latest_object(objects: DataFrame, keys: list[str], updated: str = "updated", name: str = "name") -> DataFrame:
    """A10: per key group the newest object by ``updated`` (null ignored), ties -> smallest name."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(F.desc(updated), F.asc(name))
    return (objects.where(F.col(updated).isNotNull()).withColumn("_rk", F.row_number().over(w))
                   .where(F.col("_rk") == 1).drop("_rk"))


def directory_listing(files: DataFrame, keys: list[str], rel: str = "relative_path", size: str = "size") -> DataFrame:
    """Recursive listing: every file (with size) and every directory that contains one."""
    f = files.select(*keys, F.col(rel).alias("entry"), F.lit("FILE").alias("kind"), F.col(size).alias("size"))
    d = (files.where(F.col(rel).contains("/"))
              .select(*keys, F.explode(ancestors(F.col(rel))).alias("entry"))
              .distinct()
              .select(*keys, F.concat("entry", F.lit("/")).alias("entry"), F.lit("DIR").alias("kind"),
                      F.lit(None).cast("bigint").alias("size")))
    return f.unionByName(d)


def top_level_entries(files: DataFrame, keys: list[str], rel: str = "relative_path", size: str = "size") -> DataFrame:
    """Immediate children: a directory when any file lies below it, else a file with its size."""
    first = F.split_part(F.col(rel), F.lit("/"), F.lit(1))
    is_dir = F.col(rel).contains("/")
    g = files.groupBy(*keys, first.alias("entry")).agg(
        F.max(is_dir.cast("int")).alias("_dir"),
        F.sum(F.when(~is_dir, F.col(size))).alias("_size"))
    return g.select(*keys, "entry", F.when(F.col("_dir") == 1, "DIR").otherwise("FILE").alias("kind"),
                    F.when(F.col("_dir") == 1, F.lit(None)).otherwise(F.col("_size")).cast("bigint").alias("size"))


def object_exists(names: DataFrame, objects: DataFrame, name: str = "name") -> DataFrame:
    """Does each requested name exist (left join to the listing)."""
    present = objects.select(F.col(name).alias("_n"), F.lit(True).alias("_e")).distinct()
    return (names.join(present, names[name] == present["_n"], "left")
                 .select(names[name], F.coalesce("_e", F.lit(False)).alias("exists")))


def list_files(spark, path: str, glob: str | None = None) -> DataFrame:
    """Listing of real files (content column pruned: only metadata is read): path, name below ``path``,
    length, modificationTime.  Files without bytes are not listed (Spark reads none of them)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    base = path.rstrip("/").split("/")[-1] + "/"
    rel = F.element_at(F.split(F.col("path"), "/" + base.replace(".", "[.]")), -1)
    return r.load(path).select("path", rel.alias("name"), "length", "modificationTime")


def listing_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """(name, change, length, length_before): files that are new, gone or of another length since an earlier listing."""
    n, b = now.select("name", "length"), before.select("name", F.col("length").alias("length_before"))
    change = (F.when(F.col("length_before").isNull(), "new").when(F.col("length").isNull(), "gone")
              .when(F.col("length") != F.col("length_before"), "changed"))
    return n.join(b, "name", "full_outer").withColumn("change", change).where("change IS NOT NULL").select(
        "name", "change", "length", "length_before")


def resolve_object(objects: DataFrame, prefix: str, explicit: str | None = None, name: str = "name",
                   updated: str = "updated") -> DataFrame:
    """A10 as the reference resolves its input file: an explicitly named object wins
    when it exists; otherwise the newest object under ``prefix`` (null ``updated``
    ignored, ties -> smallest name).  The result has one row; finding none fails the
    query (raise_error), it never silently returns nothing."""
    cands = objects.where(F.col(name).startswith(prefix) & F.col(updated).isNotNull())
    if explicit is not None:
        hit = objects.where(F.col(name) == explicit).select(name, updated, F.lit(0).alias("_prio"))
        cands = hit.unionByName(cands.select(name, updated, F.lit(1).alias("_prio")))
    else:
        cands = cands.select(name, updated, F.lit(1).alias("_prio"))
    best = cands.orderBy(F.asc("_prio"), F.desc_nulls_last(updated), F.asc(name)).limit(1)
    # an aggregate has a row also where there is none: that one becomes the error
    out = best.agg(F.first(name).alias(name), F.first(updated).alias(updated))
    return out.select(F.when(F.col(name).isNull(), F.raise_error(F.lit(f"no object under prefix {prefix}")))
                      .otherwise(F.col(name)).alias(name), updated)


def mirror_files(rows: DataFrame, dest: str) -> None:
    """K7 "files when asked": write each mirrored object as a file under
    ``dest/<message_id>/<relative_path>`` from the executors (``foreachPartition``).
    ``dest`` must be storage every executor can write (a shared mount on a cluster).
    A file is replaced as a whole, so a retried task is harmless; names ending in '/' are directory markers and only create the
    directory.  A name that would leave ``dest`` fails the job."""
    base = dest.rstrip("/")

    def write_partition(it):
        import os
        import uuid
        for r in it:
            path = os.path.join(base, r["message_id"], r["relative_path"])
            if not os.path.normpath(path).startswith(os.path.normpath(base) + os.sep):
                raise ValueError(f"{r['relative_path']} leaves the mirror folder")
            if r["relative_path"].endswith("/"):
                os.makedirs(path, exist_ok=True)
                continue
            os.makedirs(os.path.dirname(path), exist_ok=True)
            tmp = f"{path}.part-{uuid.uuid4().hex}"     # unique on every host that shares the folder
            with open(tmp, "wb") as fh:
                fh.write((r["content"] or "").encode("utf-8"))
            os.replace(tmp, path)          # atomic: readers never see half a file

    rows.select("message_id", "relative_path", "content").foreachPartition(write_partition)
