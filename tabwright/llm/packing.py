"""Best-fit packing of token sequences, certified and repaired by lower bounds.

Documents become pieces of at most one sequence. Groups of pieces are packed best-fit
decreasing; dual-feasible functions over the lengths give a lower bound on the number of
sequences a group needs. Groups above their bound give up their emptiest sequences; the
documents of these are dealt to new groups and packed again, as long as that saves any.
"""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import scratch_name
from tabwright.session import materialize

GROUP_ROWS = 20_000


class WordIds(dict):
    """Token ids of words (UTF-8) as little-endian 32-bit bytes, worked out when first asked for.

    For tokenizers that drop white space and never join across it, the ids of a text are
    those of its words one after the other. Words are remembered in two generations of at
    most ``most``. Words of Latin letters, with one mark behind at most, go to the model
    directly; all others through the whole tokenizer.
    """

    def __init__(self, path: str, most: int = 500_000):
        super().__init__()
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.split = self.tokenizer.model.tokenize
        self.most, self.older = most, {}
        # byte-level alphabet: printable bytes stand for themselves, others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.marks = {m: self._whole(m) for m in ".,;:!?"}

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _ids(self, raw: bytes) -> bytes:
        word = raw.decode("utf-8", "replace")
        tail = self.marks.get(word[-1]) if len(word) > 1 else None
        low = (word if tail is None else word[:-1]).lower()
        # letters below U+0250 are in composed form and lower-case one by one
        if not low.isalpha():
            return self._whole(word)
        if not low.isascii():
            if max(low) >= "ɐ":
                return self._whole(word)
            low = "".join([self.letter[b] for b in low.encode()])
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.split(low)])
        return ids if tail is None else ids + tail

    def __missing__(self, raw: bytes) -> bytes:
        ids = self.older.get(raw)
        if ids is None:
            ids = self._ids(raw)
        if len(raw) <= 64:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[raw] = ids
        return ids

    def text(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids of a whole text."""
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").split())) if text else b""


def _remembered(path: str) -> WordIds:
    """One instance per worker process and path: workers outlive tasks, the words come again."""
    store = sys.modules.setdefault("_tabwright_words", types.ModuleType("_tabwright_words")).__dict__
    if path not in store:
        store[path] = WordIds(path)
    return store[path]


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
    text_col: str = "text", keep_ids: bool = False, task_words: int | None = None,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) per piece of each document.

    A document is its text's ids (null: none) and ``end_id``; only documents longer than
    ``capacity`` are cut, into full pieces and a last one. So every row of ``docs`` has at
    least one piece, also with null or empty text; repeated rows repeat their pieces. Texts of
    any length are taken whole. With ``task_words`` a task remembers at most twice that many
    words and forgets them when it ends; else a worker process keeps a million for its next
    tasks, which is faster and costs it some 200 MB.
    """
    wanted = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = wanted.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    end = end_id.to_bytes(4, "little")

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordIds(tokenizer, task_words) if task_words else _remembered(tokenizer)
        for part in parts:
            out = []
            for i, text in zip(part["id"], part["text"], strict=True):
                ids = words.text(text) + end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    body = ids[at : at + 4 * capacity]
                    row = (i, n, at // 4, len(body) // 4, zlib.crc32(body))
                    out.append((*row, body) if keep_ids else row)
            names = ["id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + keep_ids]
            made = pd.DataFrame(out, columns=names)
            if len(made):
                made["id"] = made["id"].astype(part["id"].dtype)
            yield made

    return wanted.mapInPandas(cut, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) per item, best-fit decreasing: each into the fullest bin that has room."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, used = 0, 0  # bit r of free: a bin with room r
    for item in np.argsort(-lengths, kind="stable"):
        n = int(lengths[item])
        above = free >> n
        if above:
            r = n + (above & -above).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                free ^= 1 << r
        else:
            r, b, used = capacity, used, used + 1
        bins[item], offsets[item] = b, capacity - r
        left = r - n
        room[left].append(b)
        free |= 1 << left
    return bins, offsets


def lower_bound(histogram: np.ndarray, capacity: int) -> int:
    """Bins that items of these lengths need at least: the best of two families of dual-feasible functions.

    Family one, for each e up to half a bin: lengths above capacity - e count as a whole
    bin, below e as nothing, others as they are. Family two, for k: lengths count as
    floor((k + 1) x) / k where (k + 1) x is no whole number of bins, else as they are. Any
    set of lengths that fits in a bin adds up to one at most under each, so the rounded-up
    sum over all items is a bound. Whole-number arithmetic throughout.
    """
    x = np.arange(capacity + 1, dtype=np.int64)
    count = np.asarray(histogram, dtype=np.int64)
    volume = count * x
    below, items = np.concatenate([[0], np.cumsum(volume)]), np.concatenate([[0], np.cumsum(count)])
    best = -(-int(volume.sum()) // capacity)
    for e in range(1, capacity // 2 + 1):
        large = int(items[capacity + 1] - items[capacity - e + 1])
        middle = int(below[capacity - e + 1] - below[e])
        best = max(best, large + -(-middle // capacity))
    for k in range(1, 65):
        whole = ((k + 1) * x) % capacity == 0
        value = np.where(whole, x * k, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (capacity * k)))
    return best


def _pack_groups(capacity: int, turn: int):
    def pack(part: pd.DataFrame) -> pd.DataFrame:
        lengths = part["length"].to_numpy()
        bins, offsets = best_fit(lengths, capacity)
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        gap = len(fill) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        again = np.zeros(len(fill), bool)
        # the emptiest bins are given up: those of a gap, and the last one of each group
        give = min(len(fill), 8 * gap + 1)
        again[np.argsort(fill, kind="stable")[:give]] = True
        again &= fill < capacity
        number = (turn << 56) + (part["group"].to_numpy().astype(np.int64) << 24) + bins
        return part.assign(sequence_id=number, offset=offsets, again=again[bins])

    return pack


def pack_best_fit(pieces: DataFrame, capacity: int = 2048, group_rows: int = GROUP_ROWS, rounds: int = 6) -> DataFrame:
    """``pieces`` (a ``length`` each, 1 to ``capacity``) with sequence_id and gapless offset.

    Every round packs groups of about ``group_rows`` pieces. Sequences given up by groups
    above their lower bound are pooled, dealt to new groups and packed again; the result
    replaces them if it needs fewer. It ends when the total meets the bound over all
    lengths, when a round saves nothing, or after ``rounds`` rounds. Columns named as the
    two new ones are replaced. An empty table stays empty.
    """
    clash = {"sequence_id", "offset"} & set(pieces.columns)
    pieces = materialize(pieces.drop(*clash), "pieces")
    rename = {c: scratch_name(pieces, f"own_{c}") for c in ("group", "again") if c in pieces.columns}
    work = pieces.withColumnsRenamed(rename)
    counts = work.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts:
        histogram[r["length"]] = r["n"]
    bound = lower_bound(histogram, capacity)

    def packed(rows: DataFrame, turn: int, n: int) -> DataFrame:
        groups = max(1, -(-n // group_rows))
        dealt = rows.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(turn)), F.lit(groups)).cast("int"))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
        schema = f"{fields}, sequence_id long, offset long, again boolean"
        return materialize(dealt.groupBy("group").applyInPandas(_pack_groups(capacity, turn), schema).drop("group"), "packed")

    done: list[DataFrame] = []
    now = packed(work, 0, int(histogram.sum()))
    total = now.where(F.col("offset") == 0).count()
    for turn in range(1, rounds + 1):
        pool = now.where("again")
        size = pool.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("offset") == 0, 1).otherwise(0)).alias("bins")).first()
        if total <= bound or not size["n"] or size["bins"] < 2:
            break
        better = packed(pool.drop("sequence_id", "offset", "again"), turn, size["n"])
        bins = better.where(F.col("offset") == 0).count()
        if bins >= size["bins"]:
            break
        done.append(now.where(~F.col("again")))
        now, total = better, total - size["bins"] + bins
    out = now
    for part in done:
        out = out.unionByName(part)
    back = {v: k for k, v in rename.items()}
    return out.drop("again").withColumnsRenamed(back).select(*pieces.columns, "sequence_id", "offset")
