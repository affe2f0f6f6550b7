"""Alignment of two tokenizations of the same bytes, as columns of Arrow.

Texts are tokenized in chunks. Inside a chunk the tokens of all documents are one flat list
with parent indices; running sums of token lengths, counted from the start of each document,
give token ends. A hash join of the two token tables on (document, end) finds the ends that
both share, which cut the documents into groups, and as a full join it is the table of
links: between two neighbouring ends of either side lies exactly one overlapping pair.

Which pairs are linked in how many documents is counted per chunk, then merged by Spark.
A chunk gets the merged counts of its own pairs back, so no document is shuffled twice and
the vocabulary of pairs never meets in one task.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import join_spread
from tabwright.session import materialize

CHUNK_BYTES = 1 << 19
# words whose ids a task remembers before it starts anew
WORDS = 400_000
# a document's bytes are counted in so many bits, its place in a chunk in the rest
END_BITS = 36
SPACE = "▁"
INNER_SPACE = re.compile(f"[^{SPACE}]{SPACE}")
# spaces and what stands behind them
SEGMENT = re.compile(r" *[^ ]+| +\Z")
# white space whose run goes on behind the first space, so that a cut before that space would show
RUN = re.compile(r"[^\S ] (?: |\Z)")


def _alphabet() -> dict[str, int]:
    """Characters of the byte-level alphabet: printable bytes stand for themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Ids and token bytes of a byte-level BPE file (tokenizers json).

    Where the file is a plain one (no normalizer, the usual word pattern, merges in the order of
    their ids) the same ranks go to a faster encoder; any other file goes through its own
    pipeline. Strings of special tokens inside texts are plain text either way.
    """

    # fixed value: the word pattern of a ByteLevel step with use_regex
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _alphabet()
        special = {t["content"] for t in spec["added_tokens"]}
        vocabulary = spec["model"]["vocab"]
        self.bytes: list[bytes] = [b""] * (1 + max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in vocabulary.items():
            self.bytes[i] = token.encode() if token in special else bytes(letters[c] for c in token)
        self.fast = self._ranked(spec, special) if self._plain(spec, special) else None
        self.slow = None
        if not self.fast:
            self.slow = tokenizers.Tokenizer.from_file(path)
            self.slow.encode_special_tokens = True

    def _plain(self, spec: dict, special: set[str]) -> bool:
        model, step = spec["model"], spec["pre_tokenizer"] or {}
        pairs = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
        ids = [model["vocab"].get(p, -1) for p in pairs]
        return (
            spec["normalizer"] is None and step.get("type") == "ByteLevel" and step.get("use_regex", True)
            and not step.get("add_prefix_space") and model["type"] == "BPE" and not model.get("dropout")
            and not model.get("ignore_merges") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
            and ids == list(range(256, 256 + len(ids))) and len(model["vocab"].keys() - special) == 256 + len(ids)
        )

    def _ranked(self, spec: dict, special: set[str]) -> tiktoken.Encoding:
        ranks = {self.bytes[i]: i for t, i in spec["model"]["vocab"].items() if t not in special}
        return tiktoken.Encoding("ranks", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.fast:
            return [self.fast.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.slow.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """Ids and token bytes of a sentencepiece model."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]
        # no piece reaches over the end of a word, so merges do not either
        self.by_words = not any(INNER_SPACE.search(self.model.id_to_piece(i)) for i in range(len(self.bytes)))

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace(SPACE, " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def _lists(found: list[list[int]]) -> pa.ListArray:
    flat = array("i", chain.from_iterable(found))
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32)))


def _flat(lists: pa.ListArray, token_bytes: pa.Array) -> pa.Table:
    """(doc, id, end): all tokens of all documents, ends counted from the document's first byte."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int32())
    total = pc.cumulative_sum(pc.binary_length(token_bytes.take(ids)).cast(pa.int64()))
    # what the running sum had reached before each document
    first = pa.array(np.frombuffer(lists.buffers()[1], np.int32, len(lists) + 1, 4 * lists.offset)[:-1])
    before = pa.concat_arrays([pa.array([0], pa.int64()), total]).take(pc.subtract(first, first[0]) if len(first) else first)
    return pa.table({"doc": doc, "id": ids.cast(pa.int32()), "end": pc.subtract(total, before.take(doc))})


def _same_bytes(lists: pa.ListArray, token_bytes: pa.Array, texts: pa.Array) -> np.ndarray:
    """Per text: do its tokens' bytes, one after the other, equal it?"""
    joined = token_bytes.take(pc.list_flatten(lists)).cast(pa.large_binary())
    at = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, 8 * joined.offset)
    ends = np.frombuffer(lists.buffers()[1], np.int32, len(lists) + 1, 4 * lists.offset)
    edges = at[ends - ends[0]]
    whole = texts.cast(pa.large_binary())
    wanted = np.frombuffer(whole.buffers()[1], np.int64, len(whole) + 1, 8 * whole.offset)
    made, given = (memoryview(x.buffers()[2] or b"") for x in (joined, whole))
    if (np.diff(edges) == np.diff(wanted)).all() and made[edges[0] : edges[-1]] == given[wanted[0] : wanted[-1]]:
        return np.ones(len(texts), bool)
    spans = zip(edges[:-1].tolist(), edges[1:].tolist(), wanted[:-1].tolist(), wanted[1:].tolist(), strict=True)
    return np.array([made[a:b] == given[c:d] for a, b, c, d in spans], bool)


def _links(a: pa.Table, b: pa.Table) -> pa.Table:
    """(doc, a, b, both) in order: one row per overlapping pair of token occurrences, as positions in ``a`` and ``b``.

    ``both`` marks rows that end at a shared end. Between two neighbouring ends of either side
    lies one token of each, and two tokens share one such stretch at most, so stretches and links are the same.
    """
    # document and end in one number: a join and a sort on one key
    key = lambda t: pc.bit_wise_or(pc.shift_left(t["doc"].cast(pa.int64()), END_BITS), t["end"])
    sides = [pa.table({"key": key(t), name: pa.array(np.arange(t.num_rows, dtype=np.int64))}) for t, name in ((a, "a"), (b, "b"))]
    met = sides[0].join(sides[1], "key", join_type="full outer", use_threads=False).sort_by("key").combine_chunks()
    both = pc.and_(pc.is_valid(met["a"]), pc.is_valid(met["b"]))
    # a stretch that ends inside a token belongs to the next end of that side; the last end of a document is shared
    return pa.table({"doc": pc.shift_right(met["key"], END_BITS).cast(pa.int32()), "a": pc.fill_null_backward(met["a"]), "b": pc.fill_null_backward(met["b"]), "both": both})


def _joined(ids: pa.Array, sizes: np.ndarray, words: pa.Array) -> pa.Array:
    """Per group its ids in decimal, with commas."""
    edges = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
    return pc.binary_join(pa.LargeListArray.from_arrays(edges, words.take(ids)), ",")


class Numbers(dict):
    """Numbers of words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Aligner:
    """Tokens, groups and links of chunks of documents.

    The ids of a word are remembered for later chunks, of up to ``words`` words and those of one chunk.
    """

    def __init__(self, a_path: str, b_path: str, words: int = WORDS):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.a_bytes, self.b_bytes = pa.array(self.a.bytes, pa.binary()), pa.array(self.b.bytes, pa.binary())
        self.by_words = self.a.fast is not None and self.b.by_words
        self.words = pa.array([str(i) for i in range(max(len(self.a.bytes), len(self.b.bytes)))])
        self.most = words
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.known, self.right = Numbers(), [_lists([]), _lists([])], np.zeros(0, bool)

    def _numbered(self, words: list[str]) -> np.ndarray:
        """Numbers of words whose ids are known from here on; each new word is encoded once."""
        if len(self.numbers) > self.most:
            self._forget()
        before = len(self.numbers)
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if len(self.numbers) > before:
            *sides, right = self._encoded(list(islice(self.numbers, before, None)))
            self.known = [pa.concat_arrays([old, new]) for old, new in zip(self.known, sides, strict=True)]
            self.right = np.concatenate([self.right, right])
        return numbers

    def _encoded(self, spaced: list[str]) -> tuple[pa.ListArray, pa.ListArray, np.ndarray]:
        """Ids of both sides and whether both give back the bytes; every string begins with a space."""
        a, b = self._a_ids(spaced), _lists(self.b.encode([s[1:] for s in spaced]))
        text = pa.array(spaced, pa.string())
        return a, b, _same_bytes(a, self.a_bytes, text) & _same_bytes(b, self.b_bytes, text)

    def _a_ids(self, spaced: list[str]) -> pa.ListArray:
        """Ids of side A. Words that cannot merge with a neighbour are one text, cut at their ends."""
        alone = np.array([len(w) < 2 or w[1] == " " or w[-1].isspace() for w in spaced], bool)
        if not self.by_words or alone.all():
            return _lists(self.a.encode(spaced))
        near = np.flatnonzero(~alone)
        words = [spaced[i] for i in near.tolist()]
        one = _lists(self.a.encode(["".join(words)])).values
        ends = np.cumsum(pc.binary_length(self.a_bytes.take(one)).to_numpy())
        wanted = np.cumsum([len(w.encode()) for w in words])
        edges = np.searchsorted(ends, wanted)
        if edges[-1] >= len(ends) or (ends[edges] != wanted).any():
            return _lists(self.a.encode(spaced))
        joined = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], edges + 1]), pa.int32()), one)
        if not alone.any():
            return joined
        rest = np.flatnonzero(alone)
        place = np.empty(len(spaced), np.int64)
        place[near], place[rest] = np.arange(len(near)), len(near) + np.arange(len(rest))
        return pa.concat_arrays([joined, _lists(self.a.encode([spaced[i] for i in rest.tolist()]))]).take(pa.array(place))

    def tokens(self, texts: list[str | None]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of both sides; none where a side does not give back a space and the text.

        Neither side merges across the place where a space follows another character, and the word
        pattern looks no further than the next character. So ids of a text are those of its words
        with the spaces before them.
        """
        spaced = [" " + t if t else "" for t in texts]
        whole = {i for i, t in enumerate(spaced) if t and (not self.by_words or RUN.search(t))}
        cut = [SEGMENT.findall(t) if i not in whole else [] for i, t in enumerate(spaced)]
        at = self._numbered(list(chain.from_iterable(cut)))
        edges = np.cumsum([0, *map(len, cut)])
        right = self.right[at]
        if not right.all():
            # words that do not come back alone are left to their whole texts
            whole |= set(np.repeat(np.arange(len(cut)), np.diff(edges))[~right].tolist())
        sides = []
        for words in self.known:
            taken = words.take(pa.array(at))
            ends = np.frombuffer(taken.buffers()[1], np.int32, len(taken) + 1, 4 * taken.offset)
            sides.append(pa.ListArray.from_arrays(pa.array(ends[edges] - ends[0]), pc.list_flatten(taken)))
        if not whole:
            return sides[0], sides[1]
        rest = sorted(whole)
        *other, right = self._encoded([spaced[i] for i in rest])
        place = np.arange(len(texts))
        place[rest] = np.where(right, len(texts) + np.arange(len(rest)), -1)
        # -1: no tokens
        both = [pa.concat_arrays([x, y, pa.array([[]], x.type)]) for x, y in zip(sides, other, strict=True)]
        place[place < 0] = len(texts) + len(rest)
        return both[0].take(pa.array(place)), both[1].take(pa.array(place))

    def chunk(self, texts: list[str | None]) -> dict[str, pa.Array]:
        """Per document a_ids, b_ids, groups and links; for the chunk its distinct pairs with their documents."""
        a_ids, b_ids = self.tokens(texts)
        a, b = _flat(a_ids, self.a_bytes), _flat(b_ids, self.b_bytes)
        links = _links(a, b)
        n = len(texts)
        doc, both = links["doc"].to_numpy(), links["both"].to_numpy()
        # a group ends where both do: its tokens are those since the last shared end
        last_a, last_b = links["a"].to_numpy()[both], links["b"].to_numpy()[both]
        groups = pc.binary_join_element_wise(
            _joined(a["id"].combine_chunks(), np.diff(last_a, prepend=-1), self.words),
            _joined(b["id"].combine_chunks(), np.diff(last_b, prepend=-1), self.words), "|",
        )
        n_groups = np.bincount(doc[both], minlength=n)
        edges = pa.array(np.concatenate([[0], np.cumsum(n_groups)]).astype(np.int64))
        groups = pc.binary_join(pa.LargeListArray.from_arrays(edges, groups), ";")
        pair = pc.bit_wise_or(pc.shift_left(a["id"].take(links["a"]).cast(pa.int64()), 32), b["id"].take(links["b"]).cast(pa.int64()))
        held = pa.table({"doc": links["doc"], "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
        counts = held.group_by("pair", use_threads=False).aggregate([([], "count_all")])
        return {
            "a_ids": a_ids, "b_ids": b_ids, "groups": groups, "n_groups": n_groups, "n_links": np.bincount(doc, minlength=n),
            "held": held, "counts": counts,
        }


def _batches(rows: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts of whole documents, about ``most`` bytes at a time."""
    for batch in rows:
        texts = batch.column(1)
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + most, "right")))
            yield batch.column(0).slice(lo, hi - lo), texts.slice(lo, hi - lo).to_pylist()
            lo = hi


def align(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", keep: bool = False, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]) per row.

    Side A tokenizes a space and the text, side B the text, before which its model puts a space.
    ``groups`` lists the ids between shared ends as ``a1,a2|b1;a3|b2,b3``. ``n_links`` counts
    overlapping pairs of tokens; ``count_sum`` adds up in how many documents of the table each link's
    pair of ids is linked, ``n_best`` counts links whose pair is the most frequent of its A id, ties
    included. Null and empty texts, and texts that a side does not give back byte by
    byte, have zeros and an empty ``groups``, whose digest is empty too. Rows that repeat are
    documents of their own. Texts are whole, a longer one than ``chunk_bytes`` is a chunk by
    itself; an empty table gives no rows; other columns are not needed and not returned.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_field = rows.schema["id"]
    kind = id_field.dataType.simpleString()
    plain = "n_a long, n_b long, n_groups long, n_links long"
    digest = "groups_sha256 string" + (", groups string" if keep else "")
    schema = f"chunk long, id {kind}, {plain}, {digest}, at array<int>, times array<int>, pairs array<long>, counts array<int>"

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, part = Aligner(a_path, b_path), TaskContext.get().partitionId()
        for number, (ids, texts) in enumerate(_batches(parts, chunk_bytes)):
            got = aligner.chunk(texts)
            held, counts, n = got["held"].sort_by("doc"), got["counts"], len(texts)
            edges = np.searchsorted(held["doc"].to_numpy(), np.arange(n + 1)).astype(np.int32)
            at = pc.index_in(held["pair"], counts["pair"]).cast(pa.int32())
            # the pairs of a chunk stand in the row of its first document
            first = np.full(n + 1, counts.num_rows, np.int32)
            first[0] = 0
            texts = got["groups"].to_pylist()
            columns = {
                "chunk": pa.array(np.full(n, part << 32 | number, np.int64)), "id": ids,
                "n_a": pc.list_value_length(got["a_ids"]).cast(pa.int64()), "n_b": pc.list_value_length(got["b_ids"]).cast(pa.int64()),
                "n_groups": pa.array(got["n_groups"], pa.int64()), "n_links": pa.array(got["n_links"], pa.int64()),
                "groups_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() if x else "" for x in texts], pa.string()),
                **({"groups": pa.array(texts, pa.string())} if keep else {}),
                "at": _cut(edges, at), "times": _cut(edges, held["count_all"].cast(pa.int32())),
                "pairs": _cut(first, counts["pair"]), "counts": _cut(first, counts["count_all"].cast(pa.int32())),
            }
            yield pa.RecordBatch.from_pydict(columns)

    chunks = materialize(rows.mapInArrow(cut, schema), "chunks")
    found = chunks.where(F.size("pairs") > 0).select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "x"))
    found = found.select("chunk", "at", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    total = found.groupBy("pair").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("chunks"))
    total = materialize(total.withColumn("a", F.shiftright("pair", 32)), "pairs")
    best = materialize(total.groupBy("a").agg(F.max("n").alias("best"), F.count(F.lit(1)).alias("pairs")), "best")
    merged = join_spread(total, best, ["a"], "pairs")
    merged = materialize(merged.select("pair", F.col("n").alias("all"), (F.col("n") == F.col("best")).alias("top"), "chunks"), "merged")
    back = join_spread(found.drop("n"), merged, ["pair"], "chunks")
    back = back.groupBy("chunk").agg(F.collect_list(F.struct("at", "all", "top")).alias("known"))

    narrow = chunks.drop("pairs", "counts")
    # a chunk's counts stand before its documents
    sent = narrow.unionByName(back, allowMissingColumns=True)
    sent = sent.repartition("chunk").sortWithinPartitions("chunk", F.col("known").isNull())
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *["groups"] * keep]

    def settle(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = top = np.zeros(0, np.int64)
        for batch in parts:
            heads = np.flatnonzero(pc.is_valid(batch.column("known")).to_numpy(zero_copy_only=False)).tolist()
            for lo, hi in zip([-1, *heads], [*heads, batch.num_rows], strict=True):
                if lo >= 0:
                    known = batch.column("known")[lo].values
                    place = known.field("at").to_numpy()
                    count, top = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
                    count[place] = known.field("all").to_numpy()
                    top[place] = known.field("top").to_numpy(zero_copy_only=False)
                own = batch.slice(lo + 1, hi - lo - 1)
                if own.num_rows:
                    doc = pc.list_parent_indices(own.column("at")).to_numpy()
                    at = pc.list_flatten(own.column("at")).to_numpy()
                    times = pc.list_flatten(own.column("times")).to_numpy().astype(np.int64)
                    made = {name: own.column(name) for name in names if name in own.schema.names}
                    for name, values in (("count_sum", count), ("n_best", top)):
                        # whole numbers: a sum of doubles would round beyond 2**53
                        total = np.concatenate([[0], np.cumsum(times * values[at])])
                        edges = np.searchsorted(doc, np.arange(own.num_rows + 1))
                        made[name] = pa.array(total[edges[1:]] - total[edges[:-1]])
                    yield pa.RecordBatch.from_pydict({name: made[name] for name in names})

    return sent.mapInArrow(settle, f"id {kind}, {plain}, n_best long, count_sum long, {digest}")


def _cut(edges: np.ndarray, values: pa.ChunkedArray) -> pa.ListArray:
    """Flat values as lists between edges."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return pa.ListArray.from_arrays(pa.array(edges), values)
