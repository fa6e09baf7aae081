"""Stored token index that is brought up to date by what has changed.

Postings (token, id) lie in shards by the first characters of the token, sorted by token, so a word or prefix opens the files of its
shards only. A refresh compares a fingerprint of each product with the one it was indexed with; the postings of new and changed
products are added to their shards as a delta, and the ids of all these and of removed ones as tombstones, which hide older postings.
`merge_index` rewrites the shards that have deltas or hidden postings, and no others. Each step is one new manifest (`manifest.py`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators.search import SEARCHED, build_search_index, query_tokens, search_fts
from pricelake.session import scratch_path
from pricelake.sinks import manifest
from pricelake.sinks.tables import read_current, upsert

POSTINGS = "token string, id string, version string, shard string"
#: Deltas of one shard from which on `refresh` merges.
MERGE_AFTER = 8


def shard(token: Column | str, chars: int = 1) -> Column:
    """The first `chars` characters (or all, if the token is shorter) if they are a-z and 0-9, else the block of 256 of the first character."""
    token = F.col(token) if isinstance(token, str) else token
    plain = F.regexp_extract(token, f"^([a-z0-9]{{{chars}}}|[a-z0-9]{{1,{chars}}}$)", 1)
    return F.when(plain != "", plain).otherwise(F.concat(F.lit("u_"), F.lower(F.hex(F.floor(F.ascii(token) / 256).cast("long")))))


def _shard_of(word: str, chars: int, prefix: bool = False) -> tuple[str, ...]:
    """Shards of a word, or of all words with a prefix; the last character ``*`` stands for any."""
    block = f"u_{ord(word[0]) // 256:x}"
    plain = all(c in "abcdefghijklmnopqrstuvwxyz0123456789" for c in word[:chars])
    if prefix and len(word) < chars and plain:
        return word + "*", block
    return (word[:chars],) if plain else (block,)


def wanted(words: Sequence[str], chars: int = 1) -> list[str]:
    """Shards to read for the words of a search, of which the last one is also a prefix."""
    *whole, last = words
    return sorted({s for w in whole for s in _shard_of(w, chars)} | set(_shard_of(last, chars, True)))


def _fits(shards: Sequence[str] | None):
    return lambda s: shards is None or any(s == x or (x.endswith("*") and s.startswith(x[:-1])) for x in shards)


def read_index(spark: SparkSession, path: str, shards: Sequence[str] | None = None) -> DataFrame:
    """(token, id) of the current index, or of some shards of it."""
    _, content = manifest.latest(spark, path)
    return _postings(spark, path, content, shards).select("token", "id")


def _postings(spark: SparkSession, path: str, content: dict | None, shards: Sequence[str] | None = None) -> DataFrame:
    parts = (content or {"parts": {}})["parts"]
    folders = [f"{path}/{f}" for s, found in sorted(parts.items()) if _fits(shards)(s) for f in found]
    if not folders:
        return spark.createDataFrame([], POSTINGS)
    rows = spark.read.schema(POSTINGS).option("basePath", path).parquet(*folders)
    if shards is not None:
        match = F.lit(False)
        for s in shards:
            match = match | (F.col("shard").startswith(s[:-1]) if s.endswith("*") else F.col("shard") == s)
        rows = rows.filter(match)
    if not content["gone"]:
        return rows
    hidden = _tombstones(spark, path, content).groupBy(F.col("id").alias("_id")).agg(F.max("_at").alias("_at"))
    rows = rows.join(hidden, F.col("id") == F.col("_id"), "left")
    return rows.filter(F.col("_at").isNull() | (F.substring("version", 1, 9).cast("long") >= F.col("_at"))).drop("_id", "_at")


def _tombstones(spark: SparkSession, path: str, content: dict) -> DataFrame:
    rows = spark.read.schema("id string, version string, gone string").option("basePath", path).parquet(*[f"{path}/{f}" for f in content["gone"]])
    return rows.select("id", F.substring("version", 1, 9).cast("long").alias("_at"))


def _write(postings: DataFrame, path: str, folder: str, chars: int) -> list[str]:
    """Write postings by shard; returns the shards written."""
    rows = postings.select("token", "id").withColumn("shard", shard("token", chars))
    rows.repartitionByRange("shard", "token", "id").sortWithinPartitions("shard", "token", "id").write.partitionBy("shard").parquet(f"{path}/{folder}")
    fs, at = manifest.file_system(rows.sparkSession, path)
    return sorted(s.getPath().getName().split("=", 1)[1] for s in fs.listStatus(at(folder)) if s.getPath().getName().startswith("shard="))


def write_index(index: DataFrame, path: str, chars: int = 1) -> None:
    """Replace the whole index by (token, id) pairs; a shard is what begins with the same `chars` characters."""
    spark = index.sparkSession
    number, _ = manifest.latest(spark, path)
    folder = manifest.new_folder(number)
    made = _write(index.select("token", F.col("id").cast("string").alias("id")), path, folder, chars)
    manifest.commit(spark, path, number, {"parts": {s: [f"{folder}/shard={s}"] for s in made}, "gone": [], "chars": chars})


def refresh_index(
    products: DataFrame, path: str, id_col: str = "id", cols: Sequence[str] = SEARCHED, merge_after: int = MERGE_AFTER, chars: int = 1
) -> dict[str, int]:
    """Bring the index up to date with `products`; returns the numbers of products added, changed and removed.

    `chars`, how many first characters make a shard, is fixed when the index is first written: more of them for a larger index.
    A run that dies before its manifest changes nothing; one that dies after it is repeated with the same result.
    """
    spark = products.sparkSession
    number, content = manifest.latest(spark, path)
    known = read_current(spark, f"{path}/known") if content else None
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in cols])
    now = products.select(F.col(id_col).cast("string").alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"))
    none = spark.createDataFrame([], "id string, h1 long, h2 long")
    was = (none if known is None else known.filter("h1 IS NOT NULL")).select("id", F.col("h1").alias("o1"), F.col("h2").alias("o2"))
    both = now.join(was, "id", "full")
    kind = F.when(F.col("o1").isNull(), "added").when(F.col("h1").isNull(), "removed").when((F.col("h1") != F.col("o1")) | (F.col("h2") != F.col("o2")), "changed")
    at = scratch_path(spark, "index-changes")
    both.select("id", "h1", "h2", kind.alias("kind")).filter("kind IS NOT NULL").write.parquet(at)
    changes = spark.read.schema("id string, h1 long, h2 long, kind string").parquet(at)
    counts = {"added": 0, "changed": 0, "removed": 0} | dict(changes.groupBy("kind").count().collect())  # three rows
    if content and not any(counts.values()):
        return counts
    folder = manifest.new_folder(number)
    chars = content["chars"] if content else chars
    fresh = products.join(changes.filter("kind <> 'removed'").select(F.col("id").alias("_id")), F.col(id_col).cast("string") == F.col("_id"), "left_semi")
    index = build_search_index(fresh, id_col, cols)
    made = _write(index.select("token", F.col("id").cast("string").alias("id")), path, folder, chars)
    parts = dict((content or {"parts": {}})["parts"])
    for s in made:
        parts[s] = [*parts.get(s, []), f"{folder}/shard={s}"]
    gone = list((content or {"gone": []})["gone"])
    if content:  # added ones too: a run may have died after its manifest and before the fingerprints
        changes.select("id").write.parquet(f"{path}/{folder}/gone=ids")
        gone.append(f"{folder}/gone=ids")
    manifest.commit(spark, path, number, {"parts": parts, "gone": gone, "chars": chars})
    upsert(spark, f"{path}/known", changes.select("id", "h1", "h2"), "id", replace=content is None)
    if max((len(p) for p in parts.values()), default=0) > merge_after:
        merge_index(spark, path)
    return counts


def merge_index(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Rewrite the shards that have deltas or hidden postings into one folder each; returns their names."""
    number, content = manifest.latest(spark, path)
    if content is None:
        return []
    parts = content["parts"]
    touched = {s for s, found in parts.items() if len(found) > 1}
    if content["gone"]:
        last = _tombstones(spark, path, content).groupBy(F.col("id").alias("_id")).agg(F.max("_at").alias("_at"))
        everything = _postings(spark, path, content | {"gone": []})
        hidden = (F.col("id") == F.col("_id")) & (F.substring("version", 1, 9).cast("long") < F.col("_at"))
        touched |= {r[0] for r in everything.join(last, hidden, "left_semi").select("shard").distinct().collect()}  # at most the number of shards
    if not touched and not content["gone"]:
        return []
    folder = manifest.new_folder(number)
    made = _write(_postings(spark, path, content, sorted(touched)), path, folder, content["chars"])
    parts = {s: found for s, found in parts.items() if s not in touched} | {s: [f"{folder}/shard={s}"] for s in made}
    manifest.commit(spark, path, number, {"parts": parts, "gone": [], "chars": content["chars"]})
    manifest.clean(spark, path, keep)
    return sorted(touched)


def search_stored(products: DataFrame, path: str, term: str, id_col: str = "id") -> DataFrame:
    """`search_fts` over the stored index: only the shards of the term's words are read."""
    spark = products.sparkSession
    _, content = manifest.latest(spark, path)
    if content is None:
        raise FileNotFoundError(f"no index in {path}")
    index = _postings(spark, path, content, wanted(query_tokens(spark, term), content["chars"])).select("token", "id")
    return search_fts(index, products, term, id_col)
