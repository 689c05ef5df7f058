"""Benchmark decontamination by winnowing, in DataFrame operations only.

A window of ``window`` words keeps the least hash of the ``gram``-word sequences inside it. A window that a document
shares with a benchmark item therefore has its kept hash in both, so joining documents with the benchmark on kept hashes
finds every shared window; the hits are then extended to whole windows and compared word by word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, small, staged

#: What stands between words, which are runs of ASCII digits, ASCII letters and everything beyond ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Tables of at most so many rows of 8 or so bytes are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 1_000_000


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, BETWEEN), "")


def _window(words: str, start: Column, length: Column | int) -> Column:
    return F.translate(F.concat_ws(" ", F.slice(words, start, length)), _UPPER, _LOWER)


def _shift(name: str, by: int) -> Column:
    return F.slice(name, by + 1, F.size(name))


def _doubled(df: DataFrame, base: str, width: int, join, out: str) -> DataFrame:
    """``out``[i] is ``base``[i..i+width-1] folded with the associative-in-effect ``join``, by doubling; its tail is short."""
    name, have = base, 1
    powers = {1: base}
    while have * 2 <= width:
        nxt = f"{out}_{have * 2}"
        df = df.withColumn(nxt, F.zip_with(name, _shift(name, have), join))
        name, have = nxt, have * 2
        powers[have] = name
    bits = [p for p in sorted(powers, reverse=True) if width & p]
    name, have = powers[bits[0]], bits[0]
    for p in bits[1:]:
        nxt = f"{out}_{have + p}"
        df = df.withColumn(nxt, F.zip_with(name, _shift(powers[p], have), join))
        name, have = nxt, have + p
    return df.withColumn(out, F.col(name))


def _kept(df: DataFrame, words: str, window: int, gram: int, out: str) -> DataFrame:
    """``out``[i]: the kept hash of the window that starts at word i, for every whole window; empty if there are fewer words."""
    own = df.columns
    df = df.withColumn("__h", F.transform(words, lambda w: F.xxhash64(F.lower(w))))
    df = _doubled(df, "__h", gram, lambda a, b: F.xxhash64(a, b), "__g")
    df = _doubled(df, "__g", window - gram + 1, lambda a, b: F.least(a, b), "__m")
    whole = F.greatest(F.size(words) - (window - 1), F.lit(0))
    # windows of another length are another kind of fingerprint
    return df.withColumn(out, F.slice("__m", F.lit(1), whole)).select(*own, out)


def _grams(window: int) -> int:
    """Words to a hashed sequence: the largest power of two that leaves at least a third of the window to slide over."""
    return max(g for g in (1, 2, 4, 8, 16, 32) if g <= max(1, 2 * window // 3))


def _all_kept(df: DataFrame, words: str, lengths: list[int]) -> DataFrame:
    for n in lengths:
        df = _kept(df, words, n, _grams(n), f"kept{n}")
    return df


def overlap(docs: DataFrame, benchmark: DataFrame, window: int = 13, text_col: str = "text", id_col: str = "doc_id", item_id: str = "item_id", item_text: str = "text", key_col: str | None = None) -> DataFrame:
    """One row for each row of ``docs``: ``id_col``, ``n_words``, ``n_hit`` (words inside an occurrence of a window of an
    item) and ``items`` (sorted ids, as strings, of the items that have such a window).

    A-Z count as a-z. An item's windows are its sequences of ``window`` words; an item of fewer words, but not none, is
    one window. Null, empty and wordless texts have no words and no windows. Null ids of documents stay null; an item
    with a null id counts under the empty name. Repeated rows get equal results. Empty tables give no hits or no rows.
    Other columns of either table play no part. ``key_col`` adds the text's hash (``xxhash64``): id and hash tell rows apart
    whose ids are null or repeated.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("key", F.xxhash64("text"))
    items = staged(
        benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("text")).distinct().where("text is not null")
        .select("item", _tokens(F.col("text")).alias("words")).where(F.size("words") > 0),
        "items",
    )
    # the window lengths in use: at most ``window`` different ones
    lengths = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(window))).distinct().collect())
    if not lengths:
        lengths = [window]
    length = F.least(F.size("words"), F.lit(window))
    # hashes of words in full lower case find at least what A-Z in lower case does; the comparison below is exact
    marks = staged(reduce(DataFrame.union, [_kept(items.where(length == n), "words", n, _grams(n), "k").select(F.explode("k").alias("hash")) for n in lengths]).distinct(), "marks")
    few = lambda t: F.broadcast(t) if t.count() <= BROADCAST_ROWS else t
    kept = _all_kept(d.select("id", "key", _tokens(F.col("text")).alias("words")), "words", lengths)
    found = kept.select("id", "key", F.explode(F.array_distinct(F.concat(*[F.col(f"kept{n}") for n in lengths]))).alias("hash")).join(few(marks), "hash", "left_semi")
    hits = staged(found.groupBy("id", "key").agg(F.collect_set("hash").alias("hashes")), "hits")

    # only the texts with hits are looked at again, and where they are many the shuffle takes their keys first (a Bloom filter)
    texts = d.join(small(hits).withColumnsRenamed({"id": "hid", "key": "hkey"}), F.col("id").eqNullSafe(F.col("hid")) & (F.col("key") == F.col("hkey")))
    texts = _all_kept(texts.select("id", "key", "hashes", _tokens(F.col("text")).alias("words")), "words", lengths)

    def extended(n: int) -> Column:
        places = F.filter(F.transform(f"kept{n}", lambda x, i: F.when(F.array_contains("hashes", x), i)), lambda i: i.isNotNull())
        return F.transform(places, lambda i: F.struct(i.alias("at"), F.lit(n).alias("len"), _window("words", i + 1, n).alias("words")))

    wide = staged(texts.select("id", "key", F.concat(*[extended(n) for n in lengths]).alias("windows")), "windows")
    theirs = items.select("item", "words", length.alias("n"))
    theirs = theirs.select("item", "n", F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1), lambda i: _window("words", i, F.col("n")))).alias("words"))
    theirs = staged(theirs.groupBy("n", "words").agg(F.collect_set("item").alias("items")), "item_windows")
    ours = wide.select("id", "key", F.explode("windows").alias("w")).select("id", "key", "w.at", "w.len", "w.words").distinct()
    shared = ours.join(small(theirs), (ours["len"] == theirs["n"]) & (ours["words"] == theirs["words"]))
    runs = F.aggregate(
        F.array_sort(F.collect_list(F.struct("at", "len"))), F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum")),
        lambda s, x: F.struct(F.greatest(s["end"], x["at"] + x["len"]).alias("end"), (s["sum"] + F.greatest(F.lit(0), x["at"] + x["len"] - F.greatest(s["end"], x["at"]))).alias("sum")),
    )["sum"]
    result = shared.groupBy("id", "key").agg(runs.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")).withColumnsRenamed({"id": "rid", "key": "rkey"})
    counted = d.select("id", "key", F.coalesce(F.size(_tokens(F.col("text"))), F.lit(0)).cast("long").alias("n_words"))
    out = counted.join(small(staged(result, "overlaps")), F.col("id").eqNullSafe(F.col("rid")) & (F.col("key") == F.col("rkey")), "left")
    discard(marks, hits, wide)
    return out.select(F.col("id").alias(id_col), *([F.col("key").alias(key_col)] if key_col else []), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """At least one word is hit, and at least a twentieth of all."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
