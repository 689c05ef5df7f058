"""Substring deduplication by relative Lempel-Ziv parsing.

Every window of ``window`` words has an anchor, the least hash among its ``gram``-word sequences. Texts are cut into the
stretches that one anchor's windows cover, and the anchors' hashes deal the stretches out to reference blocks: all places
where a window can occur again lie in the block of its anchor. All stretches of a block are indexed, and each is factored
greedily against the others: from its first word on the longest match of the stretch that the index names, then on from
the factor's boundary. A factor has ``window`` words or more and is a repeated span; windows across a boundary are looked
up themselves, so that no repeat is lost. An anchor with very many stretches has several blocks; the contents of their
windows are then counted across the blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, bounded_batches, discard, objects, small, staged

_PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Texts and stretches remembered in a task to pass over copies early.
_SEEN = 100_000
#: Stretches of an anchor beyond which it has several blocks.
BLOCK = 512
EMPTY = hashlib.sha256(b"").hexdigest()


def words_of(text: str | None) -> list[bytes]:
    return WORD_BYTES.findall(text.encode("utf-8", "replace")) if text else []


def stretches(words: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor: its hash, its place, the first window it serves and the end of the last. No window: no anchor.

    The anchor is the leftmost least hash, which the window's words alone decide, so equal windows have equal anchors at
    equal distances."""
    n = len(words)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    a = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    h = np.zeros(n - gram + 1, np.uint64)
    for k in range(gram):
        h = h * _PRIME + a[k : n - gram + 1 + k]
    h ^= h >> np.uint64(31)
    h *= _PRIME
    width, at, have = window - gram + 1, np.arange(len(h)), 1
    while have * 2 <= width:
        left, right = at[:-have], at[have:]
        at, have = np.where(h[left] <= h[right], left, right), have * 2
    if have < width:
        left, right = at[: len(at) - (width - have)], at[width - have :]
        at = np.where(h[left] <= h[right], left, right)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return h[at[first]].view(np.int64), at[first], first, last + window


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, as disjoint ones in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def window_ends(body: bytes, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each window of a body of words, joined by single spaces, starts and ends."""
    gaps = np.flatnonzero(np.frombuffer(body, np.uint8) == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(body)]])
    return starts[: len(starts) - window + 1].tolist(), ends[window - 1 :].tolist()


class Block:
    """The indexed stretches of a reference block: where each content of a window occurs first, and first in another body."""

    def __init__(self, bodies: list[bytes], window: int) -> None:
        self.bodies, self.window = bodies, window
        self.bounds = [window_ends(b, window) for b in bodies]
        self.index: dict[bytes, tuple[int, int, int, int]] = {}
        for k, body in enumerate(bodies):
            for s, (a, b) in enumerate(zip(*self.bounds[k], strict=True)):
                content = body[a:b]
                found = self.index.setdefault(content, (k, s, -1, -1))
                if found[2] < 0 and found[0] != k:
                    self.index[content] = (*found[:2], k, s)

    def factors(self, k: int) -> list[tuple[int, int]]:
        """The factors of body ``k`` (first word, end), each of them in another body too; they cover all its repeated windows."""
        body, (starts, ends), out, s = self.bodies[k], self.bounds[k], [], 0
        mine = None
        while s < len(starts):
            one, at, other, there = self.index[body[starts[s] : ends[s]]]
            if one == k:
                one, at = other, there
            if one < 0:
                s += 1
                continue
            mine = mine or body.split(b" ")
            theirs = self.bodies[one].split(b" ")
            end, most = s + self.window, min(len(mine), len(theirs) + s - at)
            while end < most and mine[end] == theirs[end + at - s]:
                end += 1
            out.append((s, end))
            s = end - self.window + 1  # the first window across the factor's boundary
        return out


def parse_block(stretches: list[tuple[int, int, bytes]], window: int) -> tuple[list[tuple[int, int, int]], Block | None, dict[bytes, list[tuple[int, int]]]]:
    """The repeated spans (text, first, end) of stretches (text, first, body), their index and where each body occurs."""
    places: dict[bytes, list[tuple[int, int]]] = {}
    for uid, first, body in stretches:
        places.setdefault(body, []).append((uid, first))
    spans = []
    block = Block(list(places), window)
    for k, (body, at) in enumerate(places.items()):
        if len(at) > 1:  # a copy is one factor
            n = body.count(b" ") + 1
            spans += [(uid, first, first + n) for uid, first in at]
        elif len(places) > 1:
            (uid, first), = at
            spans += [(uid, first + a, first + b) for a, b in block.factors(k)]
    return spans, block, places


def repeated_spans(docs: DataFrame, window: int = 35, gram: int = 6, block: int = BLOCK, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row for each row of ``docs``: ``id_col``, ``text_key`` (of the text), ``n_words``, ``n_removed``, ``spans`` (disjoint
    ranges of words, in order) and ``kept_sha256``. The spans cover exactly the words in windows of ``window`` words whose
    sequence starts at two or more places of the table.

    Equal texts are one class and parsed once; a class of several rows with a window repeats as a whole. Null, empty and
    short texts have no windows. Null and repeated ids and repeated rows are rows like any other. An empty table gives an
    empty one; other columns play no part.
    """
    rows = bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()
        for part in batches:
            keys, counts, hashes, anchors = [], [], [], []
            for text in part["text"]:
                raw = (text or "").encode("utf-8", "replace")
                words = WORD_BYTES.findall(raw)
                key, found = hashlib.sha256(raw).digest()[:16], None
                if len(words) >= window and key not in seen:
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(key)
                    mine, times = np.unique(stretches(words, window, gram)[0], return_counts=True)
                    found = np.concatenate([mine, mine[times > 1]])  # twice if the text repeats it
                keys.append(key)
                counts.append(len(words))
                hashes.append(hashlib.sha256(b" ".join(words)).digest())
                anchors.append(found)
            yield pd.DataFrame({"id": part["id"], "key": objects(keys), "n_words": counts, "sha": objects(hashes), "anchors": objects(anchors)})

    id_type = dict(rows.dtypes)["id"]
    marks = staged(rows.mapInPandas(mark, f"id {id_type}, key binary, n_words long, sha binary, anchors array<long>").select("*", F.monotonically_increasing_id().alias("uid")), "marks")
    classes = marks.groupBy("key").agg(F.count("*").alias("n"), F.min(F.when(F.col("anchors").isNotNull(), F.col("uid"))).alias("rep"))
    classes = staged(classes, "classes")
    reps = marks.join(classes.where("rep is not null").select(F.col("rep").alias("uid"), "n"), "uid").select("uid", "n", F.explode("anchors").alias("anchor"))
    twice = reps.groupBy("anchor").count().where(F.col("count") > 1).select("anchor")
    shared = staged(reps.join(twice, "anchor", "left_semi").groupBy("uid", "n").agg(F.collect_set("anchor").alias("anchors")), "shared")
    wanted = marks.select("uid", "id", "key").join(shared, "uid").withColumnsRenamed({"id": "wid", "key": "wkey"})
    native_key = F.substring(F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)), 1, 16)
    # rows equal in id and text come several times; they repeat as a whole, so that this changes nothing
    texts = rows.select("id", "text", native_key.alias("key")).join(wanted, F.col("key").eqNullSafe(F.col("wkey")) & F.col("id").eqNullSafe(F.col("wid")))
    texts = staged(texts.select("uid", "text", "anchors", "n"), "texts")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, tuple[int, int, int] | None] = {}  # a task's stretches: where first; None once that has been told
        for part in batches:
            out: list[tuple] = []
            for uid, text, wanted_here in zip(part["uid"], part["text"], part["anchors"], strict=True):
                words = words_of(text)
                anchors, _, firsts, ends = stretches(words, window, gram)
                again: list[tuple[int, int]] = []
                use = np.isin(anchors, np.asarray(wanted_here, np.int64))
                for anchor, first, end in zip(anchors[use].tolist(), firsts[use].tolist(), ends[use].tolist(), strict=True):
                    body = b" ".join(words[first:end])
                    digest = xxhash.xxh128_digest(body, seed=anchor & 0xFFFFFFFF)
                    if digest in known:
                        again.append((first, end))
                        if known[digest]:
                            out.append((known[digest][0], None, *known[digest][1:], None))
                            known[digest] = None
                    else:
                        if len(known) >= _SEEN:
                            known.clear()
                        known[digest] = (uid, first, end)
                        out.append((uid, anchor, first, end, body))
                out += [(uid, None, a, b, None) for a, b in merged(again)]
                if len(out) > 20_000:
                    yield _frame(out, ("uid", "anchor", "first", "end", "body"))
                    out = []
            yield _frame(out, ("uid", "anchor", "first", "end", "body"))

    pieces = staged(texts.select("uid", "text", "anchors").mapInPandas(cut, "uid long, anchor long, first int, end int, body binary"), "pieces")
    stretches_ = pieces.where("anchor is not null").select("uid", "anchor", "first", "body")
    hot = staged(stretches_.groupBy("anchor").count().where(F.col("count") > block).select("anchor", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "hot")
    dealt = stretches_.join(small(hot), "anchor", "left").withColumn("part", F.when(F.col("blocks").isNotNull(), F.pmod(F.xxhash64("uid", "first"), "blocks")).cast("int"))
    dealt = dealt.select("anchor", "part", "uid", "first", "body").repartition("anchor", "part").sortWithinPartitions("anchor", "part")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        now: tuple | None = None
        held: list[tuple[int, int, bytes]] = []

        def close() -> None:
            if not held or (len(held) == 1 and now[1] is None):
                return
            spans, index, places = parse_block(held, window)
            out.extend((*x, None, None) for x in spans)
            if now[1] is not None:  # the anchor has other blocks: every content once, to be counted over them
                for content, (k, s, _, _) in index.index.items():
                    uid, first = places[index.bodies[k]][0]
                    out.append((uid, first + s, first + s + window, now[0], xxhash.xxh64_intdigest(content) - (1 << 63)))

        for part in batches:
            numbers = [None if n != n or n is None else int(n) for n in part["part"].tolist()]
            for anchor, number, uid, first, body in zip(part["anchor"].tolist(), numbers, part["uid"].tolist(), part["first"].tolist(), part["body"], strict=True):
                if (anchor, number) != now:
                    close()
                    now, held = (anchor, number), []
                held.append((uid, first, body))
                if len(out) > 20_000:
                    yield _frame(out, ("uid", "first", "end", "anchor", "body"))
                    out.clear()
        close()
        yield _frame(out, ("uid", "first", "end", "anchor", "body"))

    parsed = staged(dealt.mapInPandas(parse, "uid long, first int, end int, anchor long, body long"), "parsed")
    open_ = parsed.where("anchor is not null")
    again = open_.groupBy("anchor", "body").count().where(F.col("count") > 1).select("anchor", "body")
    crossing = open_.join(again, ["anchor", "body"], "left_semi").select("uid", "first", "end")
    spans = parsed.where("anchor is null").select("uid", "first", "end").union(crossing).union(pieces.where("anchor is null").select("uid", "first", "end"))
    spans = spans.groupBy("uid").agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    span_type = "array<struct<start:int,end:int>>"

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = []
            for uid, text, found in zip(part["uid"], part["text"], part["spans"], strict=True):
                words, gone = words_of(text), merged([(s["first"], s["end"]) for s in found])
                kept = [w for a, b in zip([0, *(e for _, e in gone)], [*(s for s, _ in gone), len(words)], strict=True) for w in words[a:b]]
                out.append((uid, len(words) - len(kept), [{"start": a, "end": b} for a, b in gone], hashlib.sha256(b" ".join(kept)).digest()))
            yield _frame(out, ("uid", "n_removed", "gone", "kept"))

    removed = texts.where("n = 1").select("uid", "text").join(spans, "uid").mapInPandas(remove, f"uid long, n_removed long, gone {span_type}, kept binary").withColumnRenamed("uid", "rep")
    removed = staged(removed, "removed")
    discard(shared, texts, pieces, hot, parsed)
    by_class = classes.join(removed, "rep", "left").select(F.col("key").alias("class_key"), "n", "n_removed", "gone", "kept")
    out = marks.select("id", "key", "n_words", "sha").join(by_class, F.col("key") == F.col("class_key"))
    whole = (F.col("n") > 1) & (F.col("n_words") >= window)
    everything = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"))).cast(span_type)
    return out.select(
        F.col("id").alias(id_col), F.col("key").alias("text_key"), "n_words", F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, everything).otherwise(F.coalesce("gone", F.array().cast(span_type))).alias("spans"), F.when(whole, F.lit(EMPTY)).otherwise(F.lower(F.hex(F.coalesce("kept", "sha")))).alias("kept_sha256"),
    )


def kept_text(text: Column, spans: Column) -> Column:
    """The words outside the spans, joined by single spaces."""

    @F.pandas_udf("string")
    def keep(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, gone in batches:
            out = []
            for t, g in zip(texts, gone, strict=True):
                words = words_of(t)
                for s in reversed(list(g)):
                    del words[s["start"] : s["end"]]
                out.append(b" ".join(words).decode("utf-8"))
            yield objects(out)

    return keep(text, spans)


def _frame(rows: list[tuple], columns: tuple[str, ...]) -> pd.DataFrame:
    return pd.DataFrame({c: objects([r[i] for r in rows]) for i, c in enumerate(columns)})
