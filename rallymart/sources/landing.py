"""Landed JSON: one file, or one folder of files, per entity, and versions of it once it is merged."""

from __future__ import annotations

from collections import Counter

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rallymart.operators.ingest import UPSERT_KEYS, upsert
from rallymart.operators.reshape import column
from rallymart.sources import versions
from rallymart.sources.staging import stage
from rallymart.sources.tables import table_path
from rallymart.sources.versions import Commit, Files

# Columns that say where a document stood in its page file.
PAGE_HELPERS = ("_page", "_place")
ENTITIES = ("leagues", "matches", "teams", "team_stats", "standings", "countries")

# Buckets of an entity that is written for the first time. A load rewrites the buckets it touches.
BUCKETS_SETTING = "spark.rallymart.landedBuckets"
BUCKETS_DEFAULT = 32
_BUCKET = "_landed_bucket"
# Lines that repeat every name are some ten times their size without compression.
_WRITTEN = {"ignoreNullFields": False, "compression": "gzip"}
# A character that JSON text holds only escaped.
_IN_NO_JSON = "\0"


def read_landed(
    spark: SparkSession,
    folder: str,
    entity: str,
    schema: T.StructType | None = None,
    lines: bool = False,
) -> DataFrame:
    """Documents of an entity, from `<folder>/<entity>.json`, a file or a folder of files.

    A file holding one JSON array is read whole by one task. Entities that grow are better
    landed as many files or as JSON lines (`lines=True`), which Spark splits. A document that is
    not JSON, or does not fit the schema, is an error.

    Once an entity has been written by `write_landed` or `upsert_landed` its last version is read,
    by the schema that was noted with it, so nothing is read to infer one.
    """
    commit = versions.latest(spark, versions.base_of(folder, entity))
    if commit is None or commit.plain or not commit.number:
        return _documents(spark, [f"{folder}/{entity}.json"], schema, lines)
    files, plain = Files(spark, folder), f"{folder}/{entity}.json"
    if files.exists(plain) and files.time(plain) > commit.time:
        raise ValueError(f"{plain} was landed after the entity's last version; merge or remove it")
    if schema is None and commit.schema:
        schema = T._parse_datatype_json_string(commit.schema)
    return _version(spark, versions.base_of(folder, entity), commit.folders, schema)


def _documents(spark: SparkSession, paths: list[str], schema: T.StructType | None, lines: bool) -> DataFrame:
    reader = spark.read.option("multiLine", not lines).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(paths)


def _version(spark: SparkSession, base: str, folders: dict[str, str], schema: T.StructType | None) -> DataFrame:
    if not folders and schema is not None:
        return spark.createDataFrame([], schema)
    return _documents(spark, [f"{base}/{f}" for f in sorted(folders.values())], schema, True)


def landed_entities(spark: SparkSession, folder: str) -> list[str]:
    """Names of all entities that lie in the folder, by listing alone."""
    names = Files(spark, folder).names(folder)
    plain = {n[: -len(".json")] for n in names if n.endswith(".json") and not n.startswith(".")}
    versioned = {n[1 : -len(".versions")] for n in names if n.startswith(".") and n.endswith(".versions")}
    for entity in versioned - plain:
        commit = versions.latest(spark, versions.base_of(folder, entity))
        if commit is not None and commit.number:
            plain.add(entity)
    return sorted(plain)


def _begun(spark: SparkSession, folder: str, entity: str) -> Commit:
    """The last commit; the first write notes the state before it, so folders never lack a commit."""
    base = versions.base_of(folder, entity)
    commit = versions.latest(spark, base)
    if commit is None:
        if versions.lost(spark, base):
            raise ValueError(f"{base} holds documents but no commit that names them; restore it or move them away")
        commit = Commit(plain=Files(spark, folder).exists(f"{folder}/{entity}.json"))
        versions.add(spark, base, commit)
    return commit


def _noted_schema(schema: T.StructType) -> str | None:
    """The schema as the JSON text keeps it; None if it can't be told without reading."""

    def kept(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(f.name, kept(f.dataType)) for f in kind])
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(kept(kind.elementType))
        if isinstance(kind, T.MapType | T.VariantType):
            raise TypeError
        if isinstance(kind, T.BooleanType):
            return kind
        if isinstance(kind, T.IntegralType):
            return T.LongType()
        return T.DoubleType() if isinstance(kind, T.FractionalType) else T.StringType()

    try:
        return kept(schema).json()
    except TypeError:
        return None


def _bucket(keys: tuple[str, ...], buckets: int) -> Column:
    """By the text of the keys, which is the same whatever type a load gives them."""
    return F.pmod(F.xxhash64(*[column(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _write_version(
    df: DataFrame, folder: str, entity: str, begun: Commit, keys: tuple[str, ...], buckets: int, replaced: bool
) -> None:
    """Write documents as a version of their own and commit it, beside the buckets that stay."""
    spark, base, version = df.sparkSession, versions.base_of(folder, entity), versions.new_folder()
    path = f"{base}/{version}"
    if keys:
        dealt = df.withColumn(_BUCKET, _bucket(keys, buckets)).hint("rebalance", _BUCKET)
        dealt.write.options(**_WRITTEN).partitionBy(_BUCKET).json(path)
        names = [n for n in Files(spark, base).names(path) if n.startswith(f"{_BUCKET}=")]
        written = {n.split("=")[1]: f"{version}/{n}" for n in names}
    else:
        df.write.options(**_WRITTEN).json(path)
        written = {"": version}
    commit = Commit(
        begun.number + 1, False, keys, buckets, _noted_schema(df.schema),
        written if replaced else {**begun.folders, **written},
    )
    versions.add(spark, base, commit)
    # What was landed plainly is part of the version now.
    plain, files = f"{folder}/{entity}.json", Files(spark, folder)
    if files.exists(plain):
        files.move(plain, f"{base}/replaced-{commit.number}.json")
    versions.discard_old(spark, base)


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get(BUCKETS_SETTING, str(BUCKETS_DEFAULT)))


def write_landed(df: DataFrame, folder: str, entity: str) -> None:
    """Replace an entity by JSON-lines files; fields that are NULL are kept.

    The new files become the entity's version when they are complete, so a failed write leaves it
    as it was, and `df` may read it. Documents with the keys of the entity are dealt into buckets.
    """
    spark = df.sparkSession
    keys = UPSERT_KEYS.get(entity, ())
    keys = keys if set(keys) <= set(df.columns) else ()
    begun = _begun(spark, folder, entity)
    _write_version(df, folder, entity, begun, keys, _buckets(spark) if keys else 0, True)


def upsert_landed(
    spark: SparkSession,
    folder: str,
    entity: str,
    new: DataFrame,
    load_order: tuple[str, ...] = (),
    lines: bool = True,
) -> None:
    """Merge new documents into a landed entity by its keys; the last document of a key stays.

    Only the buckets that hold a key of the load are read and written again. `lines` says how the
    entity was landed before its first merge, which reads and deals all of it. `load_order` may name
    fields of the documents or the helper columns of `read_pages`; only the helpers are left out of
    what is landed. Without it a load must not hold a key twice. A load must be the same each time
    it is read.
    """
    keys = UPSERT_KEYS[entity]
    if not load_order:
        repeated = new.groupBy(*[column(k) for k in keys]).count().filter("count > 1")
        if not repeated.isEmpty():
            raise ValueError(f"documents of {entity} share a key; say by load_order which is last")
    base, begun = versions.base_of(folder, entity), _begun(spark, folder, entity)
    dealt = begun.keys == tuple(keys)
    buckets = begun.buckets if dealt else _buckets(spark)
    if dealt:
        # At most one number for each bucket.
        touched = {str(r[0]) for r in new.select(_bucket(keys, buckets)).distinct().collect()}
        if not touched:
            return
        schema = T._parse_datatype_json_string(begun.schema) if begun.schema else None
        folders = {b: f for b, f in begun.folders.items() if b in touched}
        old = _version(spark, base, folders, schema) if folders or schema else new.limit(0)
    else:
        try:
            old = read_landed(spark, folder, entity, lines=lines)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            old = new.limit(0)  # nothing landed yet
    merged = upsert(old, new, keys, load_order).drop(*PAGE_HELPERS)
    _write_version(merged, folder, entity, begun, keys, buckets, not dealt)


# --- page files -------------------------------------------------------------------------

# Files that are listed one by one without a job.
FEW_PATHS = 32
LEDGER = "path string, length bigint, modificationTime timestamp, entity string"


def _page_files(spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Many small files that hold one JSON text each.

    Spark infers the schema of such files in few tasks, one file after the other. Taken for lines that
    end where no JSON text can, they are spread over tasks as all files are, and give the same schema.
    """
    reader = spark.read.option("mode", "FAILFAST")
    if schema is None:
        schema = reader.option("lineSep", _IN_NO_JSON).json(paths).schema
    return spark.read.option("mode", "FAILFAST").option("multiLine", True).schema(schema).json(paths)


def new_files(spark: SparkSession, folder: str, root: str, entity: str) -> DataFrame:
    """path, length and modificationTime of the files that no load of the entity has noted.

    A file that has changed since counts as new. Files are listed, not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    listed = files.select("path", "length", "modificationTime")
    if not Files(spark, root).exists(table_path(root, "loaded_files")):
        return listed
    done = spark.read.schema(LEDGER).parquet(table_path(root, "loaded_files"))
    done = done.filter(F.col("entity") == entity)
    return listed.join(done, ["path", "length", "modificationTime"], "left_anti")


def _in_folders(spark: SparkSession, pages: str, paths: list[str]) -> list[str]:
    """Folders in place of their files, where all of a folder is asked for.

    Spark lists a folder at once, but many single files by jobs with a task for each. A file that
    lands in such a folder meanwhile is merged by this load, and again by the next one.
    """
    if len(paths) <= FEW_PATHS:
        return paths
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pages)
    listed = files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).count().collect()
    above = {"/".join(r.folder.split("/")[:i]) for r in listed for i in range(1, r.folder.count("/") + 1)}
    asked = Counter(p.rsplit("/", 1)[0] for p in paths)
    whole = {r.folder for r in listed if r.folder not in above and asked[r.folder] == r["count"]}
    return sorted(whole) + [p for p in paths if p.rsplit("/", 1)[0] not in whole]


def load_new_pages(
    spark: SparkSession,
    pages: str,
    folder: str,
    entity: str,
    root: str,
    load_order: tuple[str, ...] = PAGE_HELPERS,
    schema: T.StructType | None = None,
) -> int:
    """Merge the documents of new page files into an entity; returns how many files there were.

    The loaded files are noted in the table `loaded_files` below `root` after the merge, so a stop
    between the two only means that the next load merges the same documents again. The driver gets
    the names of the new files.
    """
    found = new_files(spark, pages, root, entity).collect()
    if not found:
        return 0
    # A merge reads its load more than once.
    documents = stage(read_pages(spark, _in_folders(spark, pages, [f.path for f in found]), schema), "new-pages")
    upsert_landed(spark, folder, entity, documents, load_order)
    _note_files(spark, root, [(*f, entity) for f in found])
    return len(found)


def _note_files(spark: SparkSession, root: str, files: list[tuple]) -> None:
    noted = spark.createDataFrame(files, LEDGER)
    noted.coalesce(1).write.mode("append").parquet(table_path(root, "loaded_files"))


def page_faults(
    spark: SparkSession, folder: str | list[str], of: tuple[str, ...] = (), field: str = "data", offset: str = "offset"
) -> DataFrame:
    """Where the page files of a request do not join: `of`, expected, found, fault.

    A page says its offset; the next one must begin where it ends, the first at 0, and the last one
    is empty, as that is how a reader knows it was the last. `of` names fields that tell requests
    apart. Faults are `missing`, `repeated` (a page that begins before the end of another one) and
    `no end`; found is NULL there.
    """
    sizes = _page_files(spark, folder).select(
        *of, F.col(offset).cast("bigint").alias("found"), F.coalesce(F.size(field), F.lit(0)).alias("size")
    )
    so_far = Window.partitionBy(*of or [F.lit(0)]).orderBy("found", "size")
    whole = so_far.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = F.coalesce(F.max(F.col("found") + F.col("size")).over(so_far.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = sizes.select(
        *of, "found", "size", ends.alias("expected"), F.lead("found").over(so_far).isNull().alias("last"),
        F.max(F.col("found") + F.col("size")).over(whole).alias("end"),
    )
    gap = F.when(F.col("found") > F.col("expected"), "missing").when(F.col("found") < F.col("expected"), "repeated")
    joined = placed.select(*of, "expected", "found", gap.alias("fault"))
    ended = placed.filter("last AND size > 0").select(
        *of, F.col("end").alias("expected"), F.lit(None).cast("bigint").alias("found"), F.lit("no end").alias("fault")
    )
    return joined.filter("fault IS NOT NULL").union(ended)


def read_pages(
    spark: SparkSession,
    folder: str | list[str],
    schema: T.StructType | None = None,
    field: str = "data",
    complete: bool = False,
    of: tuple[str, ...] = (),
) -> DataFrame:
    """Documents inside page files `{"data": [...]}`; empty pages add nothing.

    `_page` and `_place` say where a document stood, which serves as load order for upserts.
    `schema` is the schema of one document. With `complete` the pages must say their offset, and one
    that is missing or repeated is an error (see `page_faults`).
    """
    if complete:
        faults = page_faults(spark, folder, of, field).limit(5).collect()
        if faults:
            raise ValueError(f"page files do not join: {', '.join(str(f.asDict()) for f in faults)}")
    page = None if schema is None else T.StructType([T.StructField(field, T.ArrayType(schema))])
    return _page_files(spark, folder, page).select(
        F.col("_metadata.file_path").alias("_page"),
        F.posexplode(F.col(field)).alias("_place", "_document"),
    ).select("_page", "_place", "_document.*")
