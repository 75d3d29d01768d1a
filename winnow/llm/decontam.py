"""Benchmark decontamination: words of documents that lie in a window of benchmark words.

Texts are cut into words of ASCII letters (A-Z as a-z), digits and characters beyond ASCII. A window is
``WINDOW`` words in a row of a benchmark item; an item of fewer words, but not none, is one window.
The hashes of all distinct windows are broadcast as a set; each text's windows are looked up in it, and
a hit counts only if the words are the same. The set has a size limit: a larger benchmark is dealt into
blocks of windows that meet it, and the texts are scanned once for each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.arrays import (
    Words, alphanumeric_words, blocks, in_one_row, lower_ascii, scramble, window_hashes, words_of,
)
from winnow.llm.shared import fresh, stored, texts_of

WINDOW = 10
#: Distinct benchmark windows that are broadcast at once, at most, some 40 MB in a worker, and bytes of them and their items.
MAX_WINDOWS, MAX_BYTES = 200_000, 64 << 20

_MEMBER, _LOWER = alphanumeric_words(), lower_ascii()
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOUND = "n_words long, n_hit long, items array<long>, spans array<struct<start: long, end: long>>"


def _words(offsets: np.ndarray, data: np.ndarray) -> Words:
    return words_of(offsets, data, _MEMBER, _LOWER)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """words (joined by a space), length, items: each distinct window and the items that hold it.

    ``benchmark`` has item_id and text. Items without words have no windows; those of an item without an
    item_id are windows like any other, but no item is listed for them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int, int]] = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = _WORD.findall((text or "").encode().translate(bytes(_LOWER)))
                size = min(window, len(words))
                for i in range(len(words) - size + 1 if size else 0):
                    out.append((b" ".join(words[i : i + size]).decode(), size, item))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            kinds = (pa.string(), pa.int32(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["words", "length", "item_id"])

    rows = benchmark.select(F.col("item_id").cast("long"), "text")
    found = rows.mapInArrow(cut, "words string, length int, item_id long")
    return found.groupBy("words", "length").agg(F.collect_set("item_id").alias("items"))


def _blocks(windows: DataFrame, max_windows: int) -> int:
    """Into how many blocks stored windows are cut: by their number, and by their bytes with those of their items."""
    size = F.octet_length("words") + 8 * F.size("items") + 64
    n, total = windows.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return max(1, -(-n // max_windows), -(-total // MAX_BYTES))


class _Set:
    """Windows by length and hash, with a bit set in front that most texts' windows do not pass."""

    def __init__(self, rows: list[tuple[str, int, list[int]]]) -> None:
        self.by_length: dict[int, tuple[np.ndarray, dict[int, list[tuple[tuple[bytes, ...], list[int]]]]]] = {}
        for length in sorted({r[1] for r in rows}):
            own = [r for r in rows if r[1] == length]
            data = np.frombuffer("\0".join(r[0] for r in own).encode(), np.uint8)
            words = _words(np.array([0, len(data)]), data)
            hashes = scramble(window_hashes(words.hash, length)[::length])
            bits = np.zeros(1 << 22, bool)
            bits[hashes >> np.uint64(42)] = True
            table: dict[int, list] = {}
            for h, (text, _, items) in zip(hashes.tolist(), own, strict=True):
                table.setdefault(h, []).append((tuple(text.encode().split(b" ")), sorted(items)))
            self.by_length[length] = bits, table

    def scan(self, offsets: np.ndarray, data: np.ndarray):
        """Per row of a block: words, hit words, items, and byte ranges of runs of hit words."""
        words, rows = _words(offsets, data), len(offsets) - 1
        n, body = len(words.hash), words.body
        hit = np.zeros(n + 1, np.int64)
        items: dict[int, set[int]] = {}
        for length, (bits, table) in self.by_length.items():
            hashes = scramble(window_hashes(words.hash, length))
            passed = np.flatnonzero(bits[hashes >> np.uint64(42)] & in_one_row(words.row, length))
            for at, h in zip(passed.tolist(), hashes[passed].tolist(), strict=True):
                for text, own in table.get(h, ()):
                    if all(
                        body[words.start[at + k] : words.end[at + k]].tobytes() == w for k, w in enumerate(text)
                    ):
                        hit[at] += 1
                        hit[at + length] -= 1
                        items.setdefault(int(words.row[at]), set()).update(own)
        hit = np.cumsum(hit[:n]) > 0
        per_row = words.per_row()
        hits = np.bincount(words.row[hit], minlength=rows)
        spans: dict[int, list[dict[str, int]]] = {}
        if hit.any():
            at = np.flatnonzero(hit)
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) > 1) | (np.diff(words.row[at]) > 0)
            firsts = np.flatnonzero(new)
            lasts = np.append(firsts[1:], len(at)) - 1
            for a, b in zip(at[firsts].tolist(), at[lasts].tolist(), strict=True):
                row = int(words.row[a])
                base = int(offsets[row])
                spans.setdefault(row, []).append(
                    {"start": int(words.start[a]) - base, "end": int(words.end[b]) - base}
                )
        return per_row, hits, items, spans


def _finder(rows: list[tuple[str, int, list[int]]]):
    made: list[_Set] = []

    @F.arrow_udf(_FOUND)
    def find(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(_Set(rows))
        out = []
        for _, offsets, data in blocks(texts):
            per_row, hits, items, spans = made[0].scan(offsets, data)
            out += [
                {"n_words": n, "n_hit": h, "items": sorted(items.get(k, ())), "spans": spans.get(k, [])}
                for k, (n, h) in enumerate(zip(per_row.tolist(), hits.tolist(), strict=True))
            ]
        return pa.array(out, _ARROW)

    return find.asNondeterministic()


_ARROW = pa.struct(
    [
        ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)


def find_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """Every row of ``docs`` as doc_id and n_words, n_hit, items, spans.

    ``spans`` are byte ranges, in the text's UTF-8, of words in a row that are hit. A null text has no
    words; an empty benchmark hits none. Rows are kept as they are, repeated ones too.
    """
    windows = stored(benchmark_windows(benchmark, window))
    parts = _blocks(windows, max_windows)
    rows = texts_of(docs).select("doc_id", "text")
    if parts == 1:
        find = _finder([tuple(r) for r in windows.collect()])
        return rows.select("doc_id", find("text").alias("found")).select("doc_id", "found.*")
    mine = F.pmod(F.xxhash64("words"), F.lit(parts))
    text_key = F.xxhash64("text")
    found = None
    for part in range(parts):
        find = _finder([tuple(r) for r in windows.where(mine == part).collect()])
        one = rows.select("doc_id", text_key.alias("key"), "text", find("text").alias("found"))
        one = stored(one.where("found.n_hit > 0").select("doc_id", "key", "text", "found.*"))
        found = one if found is None else found.unionByName(one)
    # Blocks hit few rows; what they hit in a text is joined by doc_id and a hash of the text.
    merge = _merger()
    merged = found.groupBy("doc_id", "key").agg(
        F.first("text").alias("same"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans"),
    )
    merged = merged.select("doc_id", "key", "items", merge("same", "spans").alias("m"))
    count = _finder([])
    base = rows.select("doc_id", text_key.alias("key"), count("text").alias("c"))
    base = base.select("doc_id", "key", F.col("c.n_words").alias("n_words"))
    on = [base["doc_id"].eqNullSafe(merged["doc_id"]), base["key"] == merged["key"]]
    return base.join(merged, on, "left").select(
        base["doc_id"], "n_words", F.coalesce("m.n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
        F.coalesce("m.spans", F.array().cast("array<struct<start: long, end: long>>")).alias("spans"),
    )


def _merger():
    """Unite the hit ranges of blocks and count their words."""

    @F.arrow_udf("n_hit long, spans array<struct<start: long, end: long>>")
    def merge(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, own in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            data = text.encode().translate(bytes(_LOWER))
            hit = np.zeros(len(data) + 1, np.int64)
            for s in own:
                hit[s["start"]] += 1
                hit[s["end"]] -= 1
            hit = np.cumsum(hit) > 0
            words = [m.span() for m in _WORD.finditer(data)]
            runs: list[dict[str, int]] = []
            n, joined = 0, False
            for a, b in words:
                if hit[a]:
                    n += 1
                    if joined:
                        runs[-1]["end"] = b
                    else:
                        runs.append({"start": a, "end": b})
                joined = bool(hit[a])
            out.append({"n_hit": n, "spans": runs})
        return pa.array(out, pa.struct([("n_hit", pa.int64()), _ARROW.field("spans")]))

    return merge


def remove_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """``docs`` with the hit words cut out of the texts, and n_chars set anew where there is one.

    Cutting goes on until no window is left, as words that were apart may meet. A text that loses all
    its words goes with its row; texts without hits stay as they are, null and empty ones too. All
    columns and all other rows are kept.
    """
    windows = benchmark_windows(benchmark, window).withColumn("items", F.array().cast("array<long>"))
    windows = stored(windows)
    parts = _blocks(windows, max_windows)
    if parts == 1:
        cut = _cutter([tuple(r) for r in windows.collect()])
        return _replaced(texts_of(docs), lambda out: cut("text"))
    mine = F.pmod(F.xxhash64("words"), F.lit(parts))
    (spans,) = fresh(docs, "spans")
    out, cut = texts_of(docs), _cut_at()
    while True:
        # All blocks look at the same text; what they hit goes at once.
        out = out.withColumn(spans, F.array().cast("array<struct<start: long, end: long>>"))
        for part in range(parts):
            find = _finder([tuple(r) for r in windows.where(mine == part).collect()])
            out = stored(out.withColumn(spans, F.concat(spans, find("text")["spans"])))
        if not out.where(F.size(spans) > 0).limit(1).count():
            return out.select(*docs.columns)
        out = stored(_replaced(out, lambda out: cut("text", spans)).select(*docs.columns))


def _replaced(docs: DataFrame, text) -> DataFrame:
    """Rows with a new text; a text that became null goes, and one that changed is counted anew."""
    (now,) = fresh(docs, "text_now")
    out = docs.withColumn(now, text(docs))
    changed = F.coalesce(F.col(now) != F.col("text"), F.lit(False))
    out = out.where(F.col(now).isNotNull() | F.col("text").isNull())
    columns = []
    for c in docs.columns:
        if c == "n_chars":
            n = F.when(changed, F.length(now)).otherwise(F.col(c)).cast(docs.schema[c].dataType)
            columns.append(n.alias(c))
        else:
            columns.append(F.col(now).alias(c) if c == "text" else F.col(c))
    return out.select(*columns)


def _cut_at():
    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, own in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            if own:
                data = text.encode()
                gone = np.zeros(len(data) + 1, np.int64)
                for s in own:
                    gone[s["start"]] += 1
                    gone[s["end"]] -= 1
                left = np.frombuffer(data, np.uint8)[np.cumsum(gone[:-1]) == 0].tobytes()
                # Between words that are cut, what parts them stays, as it does next to one run.
                text = left.decode() if _WORD.search(left) else None
            out.append(text)
        return pa.array(out, pa.string())

    return cut.asNondeterministic()


def _cutter(rows: list[tuple[str, int, list[int]]]):
    made: list[_Set] = []

    @F.arrow_udf("string")
    def cut(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(_Set(rows))
        out = texts.to_pylist()
        for row, offsets, data in blocks(texts):
            _, _, _, spans = made[0].scan(offsets, data)
            for k, own in spans.items():
                text = data[offsets[k] : offsets[k + 1]].tobytes()
                while own:
                    for s in reversed(own):
                        text = text[: s["start"]] + text[s["end"] :]
                    now = np.frombuffer(text, np.uint8)
                    per_row, _, _, again = made[0].scan(np.array([0, len(now)]), now)
                    own = again.get(0, [])
                out[row + k] = text.decode() if per_row[0] else None
        return pa.array(out, pa.string())

    return cut.asNondeterministic()
