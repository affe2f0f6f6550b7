"""Fill-in-middle transformation over a Roaring-style set of allowed cut offsets.

The places where a text may be cut (ends of its units) form a set of byte offsets. The set
is kept in containers of 65,536 neighbouring offsets: a sorted array where they are few, a
bitmap where they are many, runs where they stand in rows. Cumulative cardinalities over
the containers answer "the k-th cut offset" with one search for the container and one
select inside it, so the offsets of a long text are never listed for a draw.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the sentinels that frame prefix, suffix and middle
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True
SPAN = 1 << 16
ARRAY_MOST = 4096


class ArrayContainer:
    """Few offsets: sorted 16-bit numbers."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])

    def __iter__(self) -> Iterator[int]:
        return iter(self.low.tolist())


class BitmapContainer:
    """Many offsets: one bit each, with the number of bits before every 64-bit word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1
        return 64 * at + (word & -word).bit_length() - 1

    def __iter__(self) -> Iterator[int]:
        return iter(np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little")).tolist())


class RunContainer:
    """Offsets in rows: first offset of each run and the number of offsets before it."""

    def __init__(self, first: np.ndarray, before: np.ndarray, size: int):
        self.first, self.before, self.size = first.astype(np.uint16), before.astype(np.uint16), size

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[at]) + k - int(self.before[at])

    def __iter__(self) -> Iterator[int]:
        return map(self.select, range(self.size))


def _container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest of the three forms."""
    start = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    if 4 * len(start) < min(2 * len(low), SPAN // 8):
        return RunContainer(low[start], start, len(low))
    return ArrayContainer(low) if len(low) <= ARRAY_MOST else BitmapContainer(low)


class BoundarySet:
    """Sorted distinct offsets with rank order: ``select(k)`` is the k-th smallest, from 0."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        cut = np.concatenate([[0], np.flatnonzero(np.diff(high)) + 1, [len(offsets)]]) if len(offsets) else np.zeros(1, np.int64)
        self.keys = high[cut[:-1]]
        self.containers = [_container(offsets[a:b] & (SPAN - 1)) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        self.cumulative = cut

    def __len__(self) -> int:
        return int(self.cumulative[-1])

    def __iter__(self) -> Iterator[int]:
        for key, container in zip(self.keys.tolist(), self.containers, strict=True):
            yield from (key << 16 | low for low in container)

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.cumulative, k, "right")) - 1
        return int(self.keys[at]) << 16 | self.containers[at].select(k - int(self.cumulative[at]))


def cut_offsets(raw: np.ndarray, unit: str = "word") -> np.ndarray:
    """Byte offsets, 0 included, at which UTF-8 text may be cut: after words with the white space before them, or after code points."""
    if unit == "char":
        ends = np.flatnonzero((raw & 0xC0) != 0x80)
        return np.append(ends, len(raw)) if len(raw) else np.zeros(1, np.int64)
    white = WHITE[raw]
    ends = np.flatnonzero(~white[:-1] & white[1:]) + 1
    return np.concatenate([[0], ends, [len(raw)]]) if len(raw) else np.zeros(1, np.int64)


def _picker(unit: str):
    def pick(texts: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_binary())
        edges = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        out = np.zeros((3, len(texts)), np.int64)
        draws = zip(edges[:-1].tolist(), edges[1:].tolist(), first.to_pylist(), second.to_pylist(), strict=True)
        for i, (a, b, x, y) in enumerate(draws):
            text = raw[a:b]
            cuts = BoundarySet(cut_offsets(text, unit))
            n = len(cuts) - 1
            lo, hi = sorted((cuts.select(x % (n + 1)), cuts.select(y % (n + 1))))
            # bytes that begin a code point
            whole = [int(np.count_nonzero((text[p:q] & 0xC0) != 0x80)) for p, q in ((0, lo), (lo, hi))]
            out[:, i] = n, *whole
        return pa.StructArray.from_arrays([pa.array(x) for x in out], ["n", "prefix_chars", "middle_chars"])

    return pick


def _draws(seed: int, id_col: str) -> list[Column]:
    """Four unsigned 32-bit draws from the seed and the id in decimal."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = 50, spm_rate: int = 80, seed: int = 42,
    unit: str = "word",
) -> DataFrame:
    """(id, text, n, form, prefix_chars, middle_chars, output) per row.

    Texts are whole (null: empty). ``n`` units; prefix and middle end after drawn numbers of
    units. ``rate`` percent of the texts are turned, ``spm_rate`` percent of these into
    suffix-prefix-middle order. Empty texts and texts that hold a sentinel stay plain, with
    null lengths. Every draw is a hash of seed and id, so rows that repeat an id repeat its draws
    and a lost task repeats its result. A null id draws as the empty string. Texts of any
    length; an empty table gives no rows; other columns, also ones named as the new ones,
    are not needed and not returned.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    h1, h2, h3, h4 = _draws(seed, "id")
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.col("text") == "") | marked | (h3 % 100 >= rate)
    form = F.when(plain, "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    pick = F.arrow_udf(_picker(unit), "n long, prefix_chars long, middle_chars long")
    rows = rows.withColumn("form", form).withColumn("cut", pick("text", h1, h2))
    turned = F.col("form") != "plain"
    rows = rows.select(
        "id", "text", "cut.n", "form", F.when(turned, F.col("cut.prefix_chars")).alias("prefix_chars"),
        F.when(turned, F.col("cut.middle_chars")).alias("middle_chars"),
    )
    head, body = F.col("prefix_chars").cast("int"), F.col("middle_chars").cast("int")
    prefix, middle = F.col("text").substr(F.lit(1), head), F.col("text").substr(head + 1, body)
    suffix = F.col("text").substr(head + body + 1, F.char_length("text"))
    p, s, m = map(F.lit, (PREFIX, SUFFIX, MIDDLE))
    output = (
        F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(F.col("text"))
    )
    return rows.withColumn("output", output)


def restored(output: Column, form: Column) -> Column:
    """The exact text from an output and its form.

    Turned texts hold no sentinel, and none can arise where a part meets a sentinel, so the
    first place of each sentinel is the one that was put in.
    """
    at = F.locate(MIDDLE, output)
    middle = output.substr(at + len(MIDDLE), F.char_length(output))

    def parts(opening: str, inner: str) -> tuple[Column, Column]:
        cut = F.locate(inner, output)
        first = output.substr(F.lit(len(opening) + 1), cut - len(opening) - 1)
        return first, output.substr(cut + len(inner), at - cut - len(inner))

    psm, spm = parts(PREFIX, SUFFIX), parts(SUFFIX, PREFIX)
    return F.when(form == "psm", F.concat(psm[0], middle, psm[1])).when(form == "spm", F.concat(spm[1], middle, spm[0])).otherwise(output)
