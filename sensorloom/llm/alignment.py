"""Links between the tokens of two vocabularies over the same text.

A text is encoded by a byte-level BPE (A) and by a piece model (B).  Both cut the
same bytes, so that a byte offset where a token of each ends cuts both sequences
at once; the tokens between two such cuts are a group, and each A token of a
group is linked with each B token of it.

The cuts of many texts are found together, in lockstep.  A state vector holds one
A and one B pointer for each *lane*, which is a text or ``LANE`` bytes of a longer
one.  Every step compares the ends of all pointed-at tokens, emits the cut of each
lane whose two tokens end together, with the block of links that it closes,
and moves the pointer on whose token ends first, or both.  Lanes that are through
drop out of the vector.  What a step does depends on its two tokens alone, hence a
long text can be taken from several places at once, and steps are bounded by the
bytes of a lane, not by the longest text.

How many documents hold a pair of ids linked is a property of the corpus.  Pairs
are counted after a partial aggregate in each task.  The counts then go back to
the rows: those of the most frequent pairs (``FREQUENT`` at most, by a threshold
on the count) as a broadcast table, which takes nearly all links and every skewed
one; the rest meet their counts in a shuffle, where no pair is frequent.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.tables import saved

#: Bytes of a lane, and of texts that are taken together; a longer text is taken alone.
LANE, GROUP_BYTES = 2048, 1 << 21
#: Pairs of one expansion.
BLOCK_PAIRS = 1 << 21
#: From which length on a chunk is encoded alone, and how many shorter ones are together.
LONG_CHUNK, RUN_CHUNKS = 256, 4096
#: A character that no Unicode version takes for white space; a chunk ends between two of them.
_ANY_SOLID = "[^\\s\u180e\u200b-\u200f\u2060\ufeff]"
_SOLID = re.compile(f"{_ANY_SOLID}(?:.*{_ANY_SOLID})?", re.DOTALL).fullmatch
_CHUNK = re.compile(f"(?<={_ANY_SOLID}) (?={_ANY_SOLID})")
#: Most pairs whose counts are broadcast.
FREQUENT = 500_000

_ROWS = "row_id long, doc_id long, n_a long, n_b long, n_groups long, n_links long"
_LINKED = f"{_ROWS}, groups_sha256 string, pairs array<long>, times array<long>"
_ALIGNED = (
    "doc_id long, ids_a array<int>, ids_b array<int>, cuts_a array<int>, cuts_b array<int>"
)


def _byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes: printable Latin-1 as it is, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, a_json: str, b_model: bytes) -> None:
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = _byte_of_letter()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, number in self.a.get_vocab().items():
            self.a_bytes[number] = bytes(letters[c] for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)])
            if re.fullmatch("<0x[0-9A-F]{2}>", p)
            else p.replace("▁", " ").encode()
            for p in pieces
        ]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        inner_space = any("▁" in p.lstrip("▁") for p in pieces)
        self.chunk = None if inner_space else _CHUNK
        #: Id and separator: within a side, at the end of a side.
        self.written = [f"{i}{end}" for i in range(len(self.a_bytes)) for end in ",|"]
        self.written += [f"{i}{end}" for i in range(len(self.b_bytes)) for end in ",;"]

    def encode(self, texts: list[str]) -> tuple[Ragged, Ragged]:
        """A and B ids of each text; none where a vocabulary doesn't give the text back.

        A text is encoded by its chunks, which end before a space between two other
        characters.  No match of A's pattern reaches over such a place, and no piece
        of B if pieces hold spaces only in front; otherwise texts are single chunks.
        Each distinct chunk is encoded once.
        """
        chunked = [(self.chunk.split(t) if self.chunk else [t]) if t else [] for t in texts]
        number = {chunk: i for i, chunk in enumerate(dict.fromkeys(chain.from_iterable(chunked)))}
        of_a, of_b, whole = self._encode(list(number))
        bounds = np.array([0, *accumulate(map(len, chunked))], np.int64)
        used = np.fromiter(map(number.__getitem__, chain.from_iterable(chunked)), np.int64, bounds[-1])
        wrong = np.concatenate(([0], np.cumsum(~whole[used])))[bounds]
        kept = np.diff(wrong) == 0
        used, bounds = used[np.repeat(kept, np.diff(bounds))], _bounds(np.diff(bounds) * kept)
        return _taken(of_a, used, bounds), _taken(of_b, used, bounds)

    def _encode(self, chunks: list[str]) -> tuple[Ragged, Ragged, np.ndarray]:
        """A ids, B ids and whether both give it back, of each chunk with a space in front.

        Most are encoded together, with spaces between, and told apart by their bytes.
        """
        together = [
            i for i, c in enumerate(chunks) if self.chunk and len(c) < LONG_CHUNK and "▁" not in c and _SOLID(c)
        ]
        whole = np.ones(len(chunks), bool)
        order, of_a, of_b = [], [], []
        for at in range(0, len(together), RUN_CHUNKS):
            rows = together[at : at + RUN_CHUNKS]
            found = self._encode_run([chunks[i] for i in rows])
            if found is not None:
                order.append(rows)
                of_a.append(found[0])
                of_b.append(found[1])
        done = np.zeros(len(chunks), bool)
        done[list(chain.from_iterable(order))] = True
        for i in np.flatnonzero(~done).tolist():
            a, b, whole[i] = self._encode_one(chunks[i])
            order.append([i])
            of_a.append((a, np.array([0, len(a)])))
            of_b.append((b, np.array([0, len(b)])))
        place = np.empty(len(chunks), np.int64)
        place[list(chain.from_iterable(order))] = np.arange(len(chunks))
        alone = np.arange(len(chunks) + 1)
        return _taken(_joined(of_a), place, alone), _taken(_joined(of_b), place, alone), whole

    def _encode_run(self, chunks: list[str]) -> tuple[Ragged, Ragged] | None:
        a, b, whole = self._encode_one(" ".join(chunks))
        ends = np.cumsum([len(chunk.encode()) + 1 for chunk in chunks])
        of_a, of_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        last_a, last_b = np.searchsorted(of_a, ends), np.searchsorted(of_b, ends)
        if not whole or (of_a[last_a] != ends).any() or (of_b[last_b] != ends).any():
            return None
        return (a, np.concatenate(([0], last_a + 1))), (b, np.concatenate(([0], last_b + 1)))

    def _encode_one(self, text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        raw = f" {text}".encode()
        a = self.a.encode_batch_fast([f" {text}"], add_special_tokens=False)[0].ids
        b = self.b.encode(text)
        whole = (
            b"".join(map(self.a_bytes.__getitem__, a)) == raw
            and b"".join(map(self.b_bytes.__getitem__, b)) == raw
        )
        return np.array(a, np.int64), np.array(b, np.int64), whole


#: Lists one after another, and where each begins; ends with the end.
Ragged = tuple[np.ndarray, np.ndarray]


def _bounds(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes)))


def _joined(parts: list[Ragged]) -> Ragged:
    empty = np.empty(0, np.int64)
    sizes = np.concatenate([empty, *[np.diff(bounds) for _, bounds in parts]])
    return np.concatenate([empty, *[values for values, _ in parts]]), _bounds(sizes)


def _taken(lists: Ragged, numbers: np.ndarray, bounds: np.ndarray) -> Ragged:
    """The lists of these numbers; those between two bounds are joined."""
    values, starts = lists
    sizes = np.diff(starts)[numbers]
    ends = _bounds(sizes)
    at = np.repeat(starts[numbers] - ends[:-1], sizes) + np.arange(ends[-1])
    return values[at], ends[bounds]


@lru_cache(maxsize=2)
def _vocabularies(a_json: str, b_model: bytes) -> Vocabularies:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Vocabularies(a_json, b_model)


def cuts(
    ends_a: np.ndarray, ends_b: np.ndarray, bounds: np.ndarray, lane: int = LANE
) -> tuple[np.ndarray, np.ndarray]:
    """Last A token and last B token of each group, in order.

    ``ends_*`` are the ends of all tokens, of one text after another; ``bounds`` are
    the texts' own.  Each text's last tokens end together, so the blocks of links
    lie between one cut and the next, across texts, too.
    """
    sizes = np.diff(bounds)
    lanes = -(-sizes // lane)
    number = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    first = np.repeat(bounds[:-1], lanes) + number * lane
    last = np.minimum(first + lane, np.repeat(bounds[1:], lanes))
    a, b = np.searchsorted(ends_a, first, "right"), np.searchsorted(ends_b, first, "right")
    stop_a, stop_b = np.searchsorted(ends_a, last, "right"), np.searchsorted(ends_b, last, "right")
    emitted_a, emitted_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while True:
        going = (a < stop_a) & (b < stop_b)
        if not going.all():
            a, b, stop_a, stop_b = a[going], b[going], stop_a[going], stop_b[going]
        if not len(a):
            break
        end_a, end_b = ends_a[a], ends_b[b]
        cut = end_a == end_b
        emitted_a.append(a[cut])
        emitted_b.append(b[cut])
        a += end_a <= end_b
        b += end_b <= end_a
    return np.sort(np.concatenate(emitted_a)), np.sort(np.concatenate(emitted_b))


class Aligned:
    """Some texts' tokens one after another, and the cuts of all of them."""

    def __init__(self, encoded: tuple[Ragged, Ragged], known: Vocabularies) -> None:
        self.known = known
        (self.a, self.bounds_a), (self.b, self.bounds_b) = encoded
        ends_a, ends_b = np.cumsum(known.a_sizes[self.a]), np.cumsum(known.b_sizes[self.b])
        bounds = np.concatenate(([0], ends_a))[self.bounds_a]
        self.cuts_a, self.cuts_b = cuts(ends_a, ends_b, bounds)
        self.sizes_a = np.diff(self.cuts_a, prepend=-1)
        self.sizes_b = np.diff(self.cuts_b, prepend=-1)
        self.group_bounds = np.searchsorted(self.cuts_a, self.bounds_a)
        self.n_groups = np.diff(self.group_bounds)

    def n_links(self) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(self.sizes_a * self.sizes_b)))[self.group_bounds])

    def digests(self) -> list[str]:
        """Digest of each text's groups, as ids ``a1,a2|b1;a3|b2,b3``; of no tokens, nothing."""
        before_a = np.repeat(np.cumsum(self.sizes_b) - self.sizes_b, self.sizes_a)
        before_b = np.repeat(np.cumsum(self.sizes_a), self.sizes_b)
        code_a, code_b = 2 * self.a, 2 * (self.b + len(self.known.a_bytes))
        code_a[self.cuts_a] += 1
        code_b[self.cuts_b] += 1
        codes = np.empty(len(code_a) + len(code_b), np.int64)
        codes[np.arange(len(code_a)) + before_a] = code_a
        codes[np.arange(len(code_b)) + before_b] = code_b
        codes, written = codes.tolist(), self.known.written.__getitem__
        found, bounds = [], (self.bounds_a + self.bounds_b).tolist()
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            text = "".join(map(written, codes[begin:end]))[:-1]
            found.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
        return found

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the text, pair of ids, links of them) for each pair that a text has linked.

        A pair is ``A id * size of B + B id``.  Ids of a group are counted before
        they meet, and meet in blocks, so that a group of many equal tokens stays small.
        """
        group_a, ids_a, times_a = _counted(np.repeat(np.arange(len(self.sizes_a)), self.sizes_a), self.a)
        group_b, ids_b, times_b = _counted(np.repeat(np.arange(len(self.sizes_b)), self.sizes_b), self.b)
        first_b = np.searchsorted(group_b, np.arange(len(self.sizes_b) + 1))
        text = np.searchsorted(self.group_bounds, group_a, "right") - 1
        partners = np.diff(first_b)[group_a]
        ends = np.cumsum(partners)
        span = len(self.known.a_bytes) * len(self.known.b_bytes)
        keys, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        at = 0
        while at < len(group_a):
            done = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, done + BLOCK_PAIRS, "right")), at + 1)
            own = np.repeat(np.arange(at, to), partners[at:to])
            other = first_b[group_a[own]] + np.arange(len(own)) - (ends[own] - partners[own] - done)
            pair = ids_a[own] * len(self.known.b_bytes) + ids_b[other]
            keys = np.concatenate((keys, text[own] * span + pair))
            sums = np.concatenate((sums, times_a[own] * times_b[other]))
            keys, sums = _summed(keys, sums)
            at = to
        return keys // span, keys % span, sums


def _counted(groups: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    span = int(ids.max(initial=0)) + 1
    keys, times = np.unique(groups * span + ids, return_counts=True)
    return keys // span, keys % span, times


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(values, first) if len(first) else values


def _groups_of_texts(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
        text = text.as_py() or ""
        if texts and held + len(text) > GROUP_BYTES:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(doc_id)
        texts.append(text)
        held += len(text)
    if texts:
        yield ids, texts


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values).cast(kind))


def _files(a_path: str, b_path: str) -> tuple[str, bytes]:
    """Both vocabularies as they are; they are of fixed size and go with the code to the tasks."""
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        return a_file.read(), b_file.read()


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))


def aligned(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, ids_a, ids_b, cuts_a, cuts_b) for each row of (doc_id, text).

    A group ends behind the ``cuts_a[i]``-th A token and the ``cuts_b[i]``-th B token.
    Rows without tokens (null, empty, not given back by both) have empty lists.
    """
    files = _files(a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _groups_of_texts(batch):
                known = _vocabularies(*files)
                found = Aligned(known.encode(texts), known)
                counts = [found.n_groups, found.n_groups]
                local = [
                    cut + 1 - np.repeat(bounds[:-1], count)
                    for cut, bounds, count in zip(
                        (found.cuts_a, found.cuts_b), (found.bounds_a, found.bounds_b), counts, strict=True
                    )
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        _lists(found.a, found.bounds_a, pa.int32()),
                        _lists(found.b, found.bounds_b, pa.int32()),
                        *[_lists(x, found.group_bounds, pa.int32()) for x in local],
                    ],
                    names=["doc_id", "ids_a", "ids_b", "cuts_a", "cuts_b"],
                )

    return _texts(documents).mapInArrow(run, _ALIGNED)


def linked(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row for each row of (doc_id, text), with its pairs of linked ids and how often each.

    ``row_id`` tells rows apart and is new in each run, so write the table before
    reading it twice.  A pair is ``A id * size of B + B id``.
    """
    files = _files(a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for ids, texts in _groups_of_texts(batch):
                known = _vocabularies(*files)
                found = Aligned(known.encode(texts), known)
                text, pairs, times = found.links()
                bounds = np.searchsorted(text, np.arange(len(ids) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + len(ids))),
                        pa.array(ids, pa.int64()),
                        pa.array(np.diff(found.bounds_a)),
                        pa.array(np.diff(found.bounds_b)),
                        pa.array(found.n_groups.astype(np.int64)),
                        pa.array(found.n_links()),
                        pa.array(found.digests(), pa.string()),
                        _lists(pairs, bounds, pa.int64()),
                        _lists(times, bounds, pa.int64()),
                    ],
                    names=[
                        "row_id", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
                        "pairs", "times",
                    ],
                )
                row += len(ids)

    return _texts(documents).mapInArrow(run, _LINKED)


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): documents that hold a pair linked, and whether no pair of its A id has more."""
    pairs = rows.select(F.explode("pairs").alias("pair"))
    counts = saved(pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair_counts")
    counts = counts.withColumn("a", F.expr(f"pair DIV {size_b}"))
    # One row for each A id at most, so the size is bounded by the vocabulary.
    most = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("most")))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent_from(counts: DataFrame, most: int) -> int:
    """The least power of two that at most so many counts reach."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = dict(counts.groupBy(power).agg(F.count(F.lit(1))).collect())
    level, held = max(sizes, default=0) + 1, 0
    while level > 0 and held + sizes.get(level - 1, 0) <= most:
        level -= 1
        held += sizes.get(level, 0)
    return 2**level


def scored(documents: DataFrame, a_path: str, b_path: str, frequent: int = FREQUENT) -> DataFrame:
    """Counts of tokens, groups and links of each row of (doc_id, text), scored by the corpus.

    ``count_sum`` adds up, over a row's links, how many documents hold the pair of
    ids linked; ``n_best`` counts the links whose pair is held by as many as any
    pair of its A id.  Rows are documents: repeated ones count each, a null doc_id
    stays null.  Texts that are null or empty, or that a vocabulary doesn't give
    back byte by byte, have zeros and an empty digest.  An empty table gives no rows.
    """
    size_b = len(_vocabularies(*_files(a_path, b_path)).b_bytes)
    rows = saved(linked(documents, a_path, b_path), "alignments")
    counts = pair_counts(rows, size_b)
    least = _frequent_from(counts, frequent)
    links = rows.select("row_id", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")

    def sums(found: DataFrame) -> DataFrame:
        return found.groupBy("row_id").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )

    common = F.broadcast(counts.filter(F.col("n") >= least))
    found = sums(links.join(common, "pair"))
    if least > 1:
        rare = links.join(F.broadcast(common.select("pair")), "pair", "left_anti")
        both = found.unionByName(sums(rare.join(counts.filter(F.col("n") < least), "pair")))
        found = both.groupBy("row_id").agg(
            F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
        )
    return rows.join(found, "row_id", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )
