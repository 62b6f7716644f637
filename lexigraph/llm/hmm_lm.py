"""Hidden Markov language model: Baum-Welch over the whole corpus, exact likelihoods.

A token is a word or the end of a text. Tokens seen OWN_FROM times in training, at any size of the
corpus, are classes of their own; all others fall into SHARED classes by a hash of their last
letters. States emit classes and a class emits its tokens by their smoothed training counts,
whatever the state. So

    P(text) = sum over state paths of prod a(s, s') b(s', class) * prod q(token | class),

a proper distribution in which every token of the corpus counts. What every task needs has a fixed
size: the moves and the emissions of the SHARED classes. The emissions of own classes grow with the
vocabulary; they stand in parts of about PART classes, and a chunk gets those of its own tokens only.

1. Texts are cut into tokens once, in chunks of about CHUNK tokens; a chunk holds token numbers and
   its own vocabulary.
2. Vocabularies are counted by Spark over all chunks and joined back: nothing that grows with the
   corpus is broadcast or collected. A chunk then meets its tokens' counts and classes.
3. Coded chunks are written in buckets and stay where they are; only weights and counts move. Each
   round of Baum-Welch runs the scaled forward and backward recursions over the chunks. The expected
   counts of own classes are summed by part and slice of about FAN chunks, then FAN slices at a time,
   and the emissions go back to the chunks slice by slice, so no group grows with the corpus. The
   driver gets the sums of moves and SHARED classes. All ROUNDS go over all training documents, at
   every size. Shuffle files are freed with each query.
4. The scaled forward recursion scores each text exactly. A text longer than SEGMENT tokens is cut
   into segments that start in every state at once, and joined by matrix products. Segments are
   held in memory AT_ONCE tokens at a time, so a text of any length takes the same.

Defined cases: a NULL or empty text is its end alone. A document with a NULL id is held out. Rows
that repeat a doc_id are scored one by one. Without training tokens all counts are 0.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigraph.llm.common import doc_remainder, written
from lexigraph.session import delete_path, scratch_dir

STATES = 8
#: Training tokens from which on a word is a class of its own.
OWN_FROM = 5
#: Own classes of a part, about.
PART = 20_000
#: Chunks, about, whose counts of a part are summed in one group.
FAN = 64
SHARED = 2_048
CHUNK = 3_000_000
#: Tokens whose states are held in memory at once, about.
AT_ONCE = 160_000
#: Pieces that a longer text is cut into. Cutting changes no result, and costs as many forward runs as
#: there are states, so only texts go through it that are too long to run side by side with others.
SEGMENT = 16_384
#: Steps after which weights are scaled again; in between they shrink by far less than a double holds.
RESCALE = 4
MOST_BUCKETS = 10_000
ROUNDS = 10
SMOOTHING = 0.1
#: Tokens' worth of class frequencies that each state's emissions are smoothed with.
PRIOR = 200.0
SEED = 20
FOLDS = 10

END = b"\n"  # no word holds a line end
_SPREAD = 0x9E3779B97F4A7C15  # 2^64 over the golden ratio, odd: spreads numbers evenly

_DOCS = "chunk bigint, docs array<bigint>, named array<boolean>, held array<boolean>, sizes array<int>, "
_CHUNKS = _DOCS + "tokens binary, words array<string>, counts array<bigint>"
_CODED = (
    _DOCS + "classes binary, known array<bigint>, base array<double>, inside array<double>, "
    "parts array<int>, asks array<binary>, slice bigint"
)
_COUNTED = "part int, slice bigint, chunk bigint, ask binary, n binary"
_SUMMED = "part int, slice bigint, n binary"
_SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def tokens_of(text: str | None) -> list[bytes]:
    """Words in UTF-8, A-Z in lower case, and the end. Methods of bytes know ASCII only: they
    cut at blanks and U+0009 to U+000D, and change no other letters."""
    return [*text.encode().lower().split(), END] if text else [END]


# ---- step 1: chunks ----------------------------------------------------------------------

def _planes(numbers: np.ndarray) -> bytes:
    """All lowest bytes, then all second ones and so on: the high ones, mostly 0, compress well."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


#: A-Z to lower case, what cuts words to a blank, other bytes as they are.
_PLAIN = bytes(32 if i in b"\t\n\v\f\r" else i for i in bytes(range(256)).lower())


def _words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in order, and how many each has: ``tokens_of`` without the ends."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    plain = pa.py_buffer((data.to_pybytes() if data else b"").translate(_PLAIN))
    texts = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, offsets, plain], 0, texts.offset)
    found = pc.split_pattern(texts, " ")
    words, own = found.flatten(), np.asarray(pc.list_parent_indices(found))
    some = np.asarray(pc.binary_length(words)) > 0  # blanks around a text leave empty ones
    return words.filter(pa.array(some)), np.bincount(own[some], minlength=len(texts))


class _Chunk:
    """Texts gathered so far."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.rows: list[pa.RecordBatch] = []
        self.words: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.total = 0

    def add(self, rows: pa.RecordBatch, words: pa.Array, n_words: np.ndarray) -> None:
        self.rows.append(rows.select(["doc_id", "held"]))
        self.words.append(words)
        self.sizes.append(n_words + 1)
        self.total += len(words) + len(rows)

    def row(self) -> pa.RecordBatch:
        """The texts as numbers in a vocabulary of their own, the end its last."""
        rows, sizes = pa.Table.from_batches(self.rows), np.concatenate(self.sizes)
        ids, held = rows["doc_id"].combine_chunks(), np.asarray(rows["held"])
        coded = pa.concat_arrays(self.words).dictionary_encode()
        tokens = np.full(self.total, len(coded.dictionary), dtype=np.int64)
        is_word = np.ones(self.total, dtype=bool)
        is_word[np.cumsum(sizes) - 1] = False
        tokens[is_word] = coded.indices
        counts = np.bincount(tokens[np.repeat(~held, sizes)], minlength=len(coded.dictionary) + 1)
        words = pa.concat_arrays([coded.dictionary, pa.array([END], pa.large_binary())])
        made = {
            "docs": ids.fill_null(0), "named": ids.is_valid(), "held": pa.array(held),
            "sizes": pa.array(sizes, pa.int32()), "words": words.cast(pa.string()), "counts": pa.array(counts, pa.int64()),
        }
        columns = {k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for k, v in made.items()}
        columns |= {"chunk": pa.array([self.number], pa.int64()), "tokens": pa.array([_planes(tokens)], pa.binary())}
        names = ["chunk", "docs", "named", "held", "sizes", "tokens", "words", "counts"]
        return pa.RecordBatch.from_arrays([columns[k] for k in names], names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # rows come in the scan's order, so a task that runs again makes the same chunks
    chunk = _Chunk(TaskContext.get().partitionId() << 32)
    for batch in batches:
        words, n_words = _words_of(batch["text"])
        ends, row = np.r_[0, np.cumsum(n_words)], 0
        sums = ends + np.arange(len(ends))  # tokens before each row, ends included
        while row < len(batch):
            # up to the row that fills the chunk
            to = min(len(batch), int(np.searchsorted(sums, sums[row] + CHUNK - chunk.total)))
            chunk.add(batch.slice(row, to - row), words.slice(ends[row], ends[to] - ends[row]), n_words[row:to])
            row = to
            if chunk.total >= CHUNK:
                yield chunk.row()
                chunk = _Chunk(chunk.number + 1)
    if chunk.rows:
        yield chunk.row()
    del chunk
    pa.default_memory_pool().release_unused()  # the worker lives on


# ---- step 2: counts and classes ----------------------------------------------------------

@dataclass
class Classes:
    """``words``: (word, c, part, place); part -1 is the SHARED classes. ``parts``: (part, c), the training
    tokens of a part's classes in order of their places. Of the shared classes, ``tokens`` has the
    training tokens and ``mass`` what their tokens share, an unseen one included."""

    words: DataFrame
    parts: DataFrame
    n_own: int
    tokens: np.ndarray
    mass: np.ndarray


def classed_tokens(counts: DataFrame, own: int, shared: int) -> Classes:
    is_own = F.col("c") >= own
    n_own = counts.where(is_own).count()
    part = F.pmod(F.xxhash64(F.lit("part"), "word"), F.lit(-(-n_own // PART) or 1)).cast("int").alias("part")
    # hashing keeps the parts about equal, so a part's list has a bound
    parts = written(
        counts.where(is_own).select(part, "word", "c").groupBy("part")
        .agg(F.sort_array(F.collect_list(F.struct("word", "c"))).alias("w")),
        "own-classes",
    )
    numbered = parts.select("part", F.posexplode("w").alias("place", "w"))
    suffix = F.pmod(F.xxhash64(F.substring("word", -3, 3)), F.lit(shared)).cast("int").alias("place")
    rare = counts.where(~is_own).select("word", "c", F.lit(-1).alias("part"), suffix)
    totals = (
        rare.where(F.col("c") > 0).groupBy("place")
        .agg(F.sum("c").alias("c_class"), F.count(F.lit(1)).alias("v_class"))
    )
    tokens, kinds = np.zeros(shared), np.zeros(shared)
    for row in totals.collect():
        tokens[row["place"]], kinds[row["place"]] = row["c_class"], row["v_class"]
    words = numbered.select("w.word", "w.c", "part", "place").unionByName(rare)
    return Classes(
        words, parts.select("part", F.col("w.c").alias("c")), n_own, tokens, tokens + SMOOTHING * (kinds + 1)
    )


def _code(total: int, kinds: int, mass: np.ndarray, shared: int, slices: int):  # noqa: ANN202
    """Chunks with their tokens' counts to chunks of classes with the scores that need no model.
    Own classes follow the shared ones, numbered by part and place among those of the chunk."""
    def run(chunks: pd.DataFrame, tokens: pd.DataFrame) -> pd.DataFrame:
        row = chunks.iloc[0]
        of = np.argsort(tokens["number"].to_numpy())
        c, part, place = (tokens[x].to_numpy()[of] for x in ("c", "part", "place"))
        rare = part < 0
        inside = np.zeros(len(c))
        inside[rare] = np.log10((c[rare] + SMOOTHING) / mass[place[rare]])
        order = np.lexsort((place, part))[rare.sum():]
        kind = place.astype(np.int64)
        kind[order] = shared + np.arange(len(order))
        cuts = np.flatnonzero(np.r_[True, np.diff(part[order]) != 0]) if len(order) else np.zeros(0, dtype=int)
        asks = [x.astype("<i4").tobytes() for x in np.split(place[order], cuts[1:])] if len(order) else []
        ids = _from_planes(row["tokens"])
        sizes = np.asarray(row["sizes"], dtype=np.int64)
        at = np.cumsum(sizes) - sizes
        base = np.log10((c + SMOOTHING) / (total + SMOOTHING * (kinds + 1)))
        sums = [np.add.reduceat(x[ids], at) for x in ((c > 0).astype(np.int64), base, inside)]
        return pd.DataFrame({
            **{k: [row[k]] for k in ("chunk", "docs", "named", "held", "sizes")},
            "classes": [_planes(kind[ids])],
            "known": [sums[0]], "base": [sums[1]], "inside": [sums[2]],
            "parts": [part[order][cuts].astype("int32")], "asks": [asks],
            "slice": [(int(row["chunk"]) * _SPREAD % (1 << 64) >> 32) % slices],
        })

    return run


# ---- steps 3 and 4: recursions -----------------------------------------------------------

@dataclass
class Parameters:
    start: np.ndarray  # (states)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (classes, states)


def first_moves(states: int) -> tuple[np.ndarray, np.ndarray]:
    """Any state first, then sticky moves."""
    move = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    return np.full(states, 1 / states), move


def _tilted(shares: np.ndarray, states: int, part: int) -> np.ndarray:
    """First emissions of a part's classes, not yet of sum 1: their shares, each tilted at random."""
    return shares[:, None] * (np.random.default_rng([SEED, part + 1]).gamma(1.0, size=(len(shares), states)) + 0.1)


class _Lanes:
    """Segments side by side, longest first: at step t the first ``alive[t]`` go on. ``flat`` has their
    classes step by step, ``seen`` a block per step: what each state (a row) emits there, gathered once
    from ``emit``, which has a row per state too."""

    def __init__(self, emit: np.ndarray, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        steps = np.arange(int(lengths[0]))
        alive = np.searchsorted(-lengths, -steps, side="left")
        self.alive, self.offset = alive.tolist(), np.r_[0, np.cumsum(alive)].tolist()
        self.flat = np.empty(self.offset[-1], dtype=np.int64)
        self.seen = self.blocks(len(emit))
        for t, n in enumerate(self.alive):
            here = self.flat[self.offset[t] : self.offset[t + 1]]
            here[:] = classes[t:].take(starts[:n])
            emit.take(here, axis=1, out=self.seen[t], mode="clip")

    def blocks(self, rows: int) -> list[np.ndarray]:
        """Room for ``rows`` numbers of each lane at each step. What a step uses lies together."""
        room = np.empty(rows * len(self.flat))
        return [room[rows * a : rows * b].reshape(rows, -1) for a, b in zip(self.offset, self.offset[1:])]


def _forward(p: Parameters, x: _Lanes, entry: np.ndarray, keep: bool = False):  # noqa: ANN202
    """The scaled forward recursion from ``entry``, the states' weights before a segment's first
    emission: log likelihood and last weights of each lane, and what these are scaled by; with ``keep``
    also the weights and scales of each step. Arrays have a row per state, so that every operation runs
    along the lanes. Every RESCALE steps weights are scaled to sum 1."""
    last, log = np.empty_like(entry), np.zeros(entry.shape[1])
    alphas = x.blocks(len(entry)) if keep else None
    scales: dict[int, np.ndarray] = {}
    alpha, onward = entry, np.ascontiguousarray(p.move.T)
    for t, (n, stay, seen) in enumerate(zip(x.alive, [*x.alive[1:], 0], x.seen)):
        now = alphas[t] if keep else np.empty_like(seen)
        if t:
            np.matmul(onward, alpha[:, :n], out=now)
            now *= seen
        else:
            np.multiply(entry, seen, out=now)
        if t % RESCALE == 0:
            scale = np.add.reduce(now, axis=0)
            now /= scale
            log[:n] += np.log(scale)
            if keep:
                scales[t] = scale
        if stay < n:
            last[:, stay:n] = now[:, stay:]
        alpha = now
    tail = np.add.reduce(last, axis=0)
    return log + np.log(tail), last / tail, tail, alphas, scales


def _backward(p: Parameters, x: _Lanes, leave: np.ndarray, last: np.ndarray, tail: np.ndarray, alphas, scales):  # noqa: ANN001, ANN202
    """Expected moves inside the lanes, for each lane the weights of its first emission with all that
    follows, and the states' probabilities (a row per state) at every step. ``x.seen`` is used up. With
    the scales of the forward recursion both recursions' products sum to 1 at every step, if they do at
    the last."""
    beta = leave / (np.einsum("ij,ij->j", last, leave) * tail)
    gammas = np.empty((len(beta), len(x.flat)))
    moves, step = np.zeros_like(p.move), np.empty_like(p.move)
    for t in range(len(x.alive) - 1, -1, -1):
        n, back = x.alive[t], x.seen[t]
        after = beta[:, :n]
        np.multiply(alphas[t], after, out=gammas[:, x.offset[t] : x.offset[t + 1]])
        back *= after
        if t % RESCALE == 0:
            back /= scales[t]
        if t:
            np.matmul(alphas[t - 1][:, :n], back.T, out=step)
            moves += step
            np.matmul(p.move, back, out=after)
    return p.move * moves, x.seen[0], gammas


def _segments(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text of all segments of at most ``most`` tokens."""
    pieces = -(-sizes // most)
    text = np.repeat(np.arange(len(sizes)), pieces)
    number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    offset = np.cumsum(sizes) - sizes
    return offset[text] + number * most, np.minimum(most, sizes[text] - number * most), text


def _groups(lengths: np.ndarray) -> list[np.ndarray]:
    """Segments of like length, about AT_ONCE tokens a group, each group longest first. Groups bound the
    memory of a text of any length."""
    order = np.argsort(-lengths, kind="stable")
    before = np.cumsum(lengths[order]) - lengths[order]
    return np.split(order, np.flatnonzero(np.diff(before // AT_ONCE)) + 1)


def _borders(p: Parameters, by_state: np.ndarray, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, text: np.ndarray):  # noqa: ANN202
    """For each segment (a column) the states' weights before its first emission, and those of what
    follows its last token, just as the recursions over the whole text give them."""
    states = len(p.start)
    entry = np.repeat(p.start[:, None], len(starts), axis=1)
    leave = np.ones((states, len(starts)))
    many = np.flatnonzero(np.bincount(text)[text] > 1)
    if not len(many):
        return entry, leave
    through = np.empty((len(many), states, states))  # entered in, left in
    logs = np.empty((len(many), states))
    for lanes in _groups(lengths[many]):
        x = _Lanes(by_state, classes, starts[many[lanes]], lengths[many[lanes]])
        for s in range(states):
            one = np.zeros((states, len(lanes)))
            one[s] = 1.0
            log, last, *_ = _forward(p, x, one)
            logs[lanes, s], through[lanes, s] = log, last.T
    through *= np.exp(logs - logs.max(axis=1, keepdims=True))[:, :, None]
    own = text[many]
    for i in range(1, len(many)):
        if own[i] == own[i - 1]:
            w = entry[:, many[i - 1]] @ through[i - 1] @ p.move
            entry[:, many[i]] = w / w.sum()
    for i in range(len(many) - 2, -1, -1):
        if own[i] == own[i + 1]:
            w = p.move @ (through[i + 1] @ leave[:, many[i + 1]])
            leave[:, many[i]] = w / w.sum()
    return entry, leave


def log_likelihoods(p: Parameters, classes: np.ndarray, sizes: np.ndarray, most: int = SEGMENT) -> np.ndarray:
    """Natural logarithm of the probability of each text's classes."""
    out = np.zeros(len(sizes))
    if len(sizes):
        starts, lengths, text = _segments(sizes, most)
        by_state = np.ascontiguousarray(p.emit.T)
        entry, _ = _borders(p, by_state, classes, starts, lengths, text)
        log = np.empty(len(starts))
        for lanes in _groups(lengths):
            x = _Lanes(by_state, classes, starts[lanes], lengths[lanes])
            log[lanes] = _forward(p, x, entry[:, lanes])[0]
        np.add.at(out, text, log)
    return out


def expected_counts(p: Parameters, classes: np.ndarray, sizes: np.ndarray, most: int = SEGMENT):  # noqa: ANN202
    """Counts of first states, moves and emissions expected under ``p``, and the log likelihood."""
    states = len(p.start)
    start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros((states, len(p.emit)))
    if not len(sizes):
        return start, move, emit.T, 0.0
    starts, lengths, text = _segments(sizes, most)
    by_state = np.ascontiguousarray(p.emit.T)
    entry, leave = _borders(p, by_state, classes, starts, lengths, text)
    first = np.r_[True, text[1:] != text[:-1]]
    ends, onto, total = np.empty_like(entry), np.empty_like(entry), 0.0
    for lanes in _groups(lengths):
        x = _Lanes(by_state, classes, starts[lanes], lengths[lanes])
        log, last, *kept = _forward(p, x, entry[:, lanes], keep=True)
        inside, begun, gammas = _backward(p, x, leave[:, lanes], last, *kept)
        total += float(log.sum())
        move += inside
        start += gammas[:, : len(lanes)][:, first[lanes]].sum(axis=1)
        ends[:, lanes], onto[:, lanes] = last, begun
        for s in range(states):
            emit[s] += np.bincount(x.flat, weights=gammas[s], minlength=len(p.emit))
    inner = np.flatnonzero(~first)
    if len(inner):  # moves from the end of one segment to the next
        before, after = ends[:, inner - 1], onto[:, inner]
        move += p.move * (before @ (after / np.einsum("ij,ij->j", before, p.move @ after)).T)
    return start, move, emit.T, total


def _of(row: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    return _from_planes(row["classes"]), np.asarray(row["sizes"], dtype=np.int64)


@dataclass
class Model:
    """What every task needs: ``common``, the emissions of shared classes; ``norm``, the sums over all
    classes that emissions of own ones, sent as weights, are divided by."""

    start: np.ndarray
    move: np.ndarray
    common: np.ndarray
    norm: np.ndarray

    def of(self, sent: pd.DataFrame) -> Parameters:
        """Parameters for a chunk with the own classes' weights that were sent to it."""
        states = len(self.start)
        own = [np.frombuffer(x, "<f4").reshape(-1, states) for x in sent.sort_values("part")["w"]]
        emit = np.empty((len(self.common) + sum(map(len, own)), states))  # filled in place: no second copy
        emit[: len(self.common)] = self.common
        at = len(self.common)
        for w in own:
            np.divide(w, self.norm, out=emit[at : at + len(w)])
            at += len(w)
        return Parameters(self.start, self.move, emit)


def _sent(coded: DataFrame, weights: DataFrame, slices: int, states: int) -> DataFrame:
    """(chunk, part, w): the weights of own classes to the chunks that ask. A group has one part and the
    chunks of one slice, however many chunks there are."""
    asked = coded.select("slice", "chunk", F.explode(F.arrays_zip("parts", "asks")).alias("a")).select(
        F.col("a.parts").alias("part"), "slice", "chunk", F.col("a.asks").alias("ask")
    )
    spread = weights.select("part", "w", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<bigint>")).alias("slice"))

    def serve(asks: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        w = np.frombuffer(part["w"].iloc[0], "<f4").reshape(-1, states)
        return pd.DataFrame({
            "chunk": asks["chunk"].astype("int64"), "part": asks["part"].astype("int32"),
            "w": [w[np.frombuffer(a, "<i4")].tobytes() for a in asks["ask"]],
        })

    return (
        asked.groupBy("part", "slice").cogroup(spread.groupBy("part", "slice"))
        .applyInPandas(serve, "chunk bigint, part int, w binary")
    )


def _add_chunks(states: int):  # noqa: ANN202
    """Counts of a part in the chunks of a slice to their sum, as far as the last class that they have.
    Part -1 has the counts that every chunk has."""
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk", kind="stable")  # so that sums come out the same
        if (part := int(rows["part"].iloc[0])) < 0:
            total = np.sum([np.frombuffer(n, "<f8") for n in rows["n"]], axis=0)
        else:
            asks = [np.frombuffer(a, "<i4") for a in rows["ask"]]
            total = np.zeros((max(int(a.max()) for a in asks) + 1, states))
            for ask, n in zip(asks, rows["n"]):
                total[ask] += np.frombuffer(n, "<f4").reshape(-1, states)
        return pd.DataFrame({
            "part": np.array([part], dtype="int32"), "slice": [int(rows["slice"].iloc[0])], "n": [total.tobytes()]
        })

    return add


def _add_slices(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of several slices to one; a slice's sum may end before another's."""
    found = [np.frombuffer(n, "<f8") for _, n in sorted(zip(rows["below"], rows["n"]))]
    total = np.zeros(max(map(len, found)))
    for n in found:
        total[: len(n)] += n
    return pd.DataFrame({
        "part": rows["part"].iloc[:1].astype("int32"), "slice": rows["slice"].iloc[:1], "n": [total.tobytes()]
    })


def _whole(sums: DataFrame, slices: int) -> DataFrame:
    """Sums over all slices, FAN at a time, as many levels as it takes."""
    while slices > 1:
        slices = -(-slices // FAN)
        above = sums.select("part", F.floor(F.col("slice") / FAN).alias("slice"), F.col("slice").alias("below"), "n")
        sums = written(above.groupBy("part", "slice").applyInPandas(_add_slices, _SUMMED), "lm-sums")
    return sums


def _weights(parts: DataFrame, sums: DataFrame | None, total: float, states: int) -> DataFrame:
    """(part, w): the weights of a part's classes, from the sums of all chunks or, without, the first ones."""
    first = sums is None

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, c, n in zip(batch["part"], batch["c"], batch["n"]):
                shares = (np.asarray(c, dtype=np.float64) + SMOOTHING) / total
                if first:
                    w = _tilted(shares, states, int(part))
                else:
                    w = np.repeat(PRIOR * shares[:, None], states, axis=1)
                    if n is not None:
                        seen = np.frombuffer(n, "<f8").reshape(-1, states)
                        w[: len(seen)] += seen
                yield pd.DataFrame({"part": np.array([part], dtype="int32"), "w": [w.astype("<f4").tobytes()]})

    if first:
        rows = parts.withColumn("n", F.lit(None).cast("binary"))
    else:
        rows = parts.join(sums.where(F.col("part") >= 0).select("part", "n"), "part", "left")
    return written(rows.mapInPandas(weigh, "part int, w binary"), "lm-weights")


def _discard(df: DataFrame) -> None:
    """Delete a scratch table that nothing reads any more."""
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        delete_path(df.sparkSession, path)


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the query that wrote them; every query here writes a table or returns a row."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _round(coded: DataFrame, weights: DataFrame, model: Model, slices: int):  # noqa: ANN202
    """One expectation step over the training documents: counts of first states, moves and shared
    classes, the log likelihood, and the table of the sums of own classes."""
    shared = coded.sparkSession.sparkContext.broadcast(model)
    states, common = len(model.start), len(model.common)

    def count(chunks: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        row, q = chunks.iloc[0], shared.value.of(own)
        (classes, sizes), keep = _of(row), ~np.asarray(row["held"], dtype=bool)
        classes, sizes = classes[np.repeat(keep, sizes)], sizes[keep]
        start, move, emit, log = expected_counts(q, classes, sizes)
        del q, classes  # before the counts are copied out
        ends = common + np.cumsum([len(a) // 4 for a in row["asks"]]).astype(int)
        each = np.split(emit[common:].astype("<f4"), ends[:-1] - common) if len(ends) else []
        rest = np.concatenate([start, move.ravel(), emit[:common].ravel(), [log]])
        return pd.DataFrame({
            "part": [*row["parts"], -1], "slice": int(row["slice"]), "chunk": int(row["chunk"]),
            "ask": [*row["asks"], None], "n": [*(x.tobytes() for x in each), rest.tobytes()],
        })

    counted = (
        coded.select("slice", "chunk", "held", "sizes", "classes", "parts", "asks").groupBy("chunk")
        .cogroup(_sent(coded, weights, slices, states).groupBy("chunk")).applyInPandas(count, _COUNTED)
    )
    summed = counted.groupBy("part", "slice").applyInPandas(_add_chunks(states), _SUMMED)
    sums = _whole(written(summed, "lm-sums"), slices)
    row = sums.where(F.col("part") < 0).select("n").first()
    rest = np.frombuffer(row["n"], "<f8") if row else np.zeros(states + states * states + common * states + 1)
    start, move, emit, log = np.split(rest, np.cumsum([states, states * states, common * states]))
    return start, move.reshape(states, states), emit.reshape(common, states), float(log[0]), sums


def train(coded: DataFrame, classes: Classes, slices: int, states: int = STATES) -> tuple[Model, DataFrame]:
    """Rounds of Baum-Welch: the model and the table of weights of own classes."""
    n_taught = classes.parts.select(F.explode("c").alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    total = float(n_taught + classes.tokens.sum() + SMOOTHING * (classes.n_own + len(classes.tokens)))
    shares = (classes.tokens + SMOOTHING) / total

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, c in zip(batch["part"], batch["c"]):
                sums = _tilted((np.asarray(c, dtype=np.float64) + SMOOTHING) / total, states, int(part)).sum(axis=0)
                yield pd.DataFrame({"s": np.arange(states), "n": sums})

    norm = (common := _tilted(shares, states, -1)).sum(axis=0)
    for s, n in classes.parts.mapInPandas(summed, "s int, n double").groupBy("s").agg(F.sum("n")).collect():
        norm[s] += n
    model = Model(*first_moves(states), common / norm, norm)
    weights = _weights(classes.parts, None, total, states)
    for _ in range(ROUNDS):
        start, move, emit, _, sums = _round(coded, weights, model, slices)
        # each state's expected tokens: those it starts with and those it is moved to
        norm = start + move.sum(axis=0) + PRIOR
        start, move = start + SMOOTHING, move + SMOOTHING
        model = Model(
            start / start.sum(), move / move.sum(axis=1, keepdims=True), (emit + PRIOR * shares[:, None]) / norm, norm
        )
        old, weights = weights, _weights(classes.parts, sums, total, states)
        _discard(old)
        _discard(sums)
    return model, weights


def _by_chunk(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` written in buckets by chunk, so that rounds read the chunks where they lie. The name in the
    catalog is only needed to read the table once; its files are those of a scratch folder."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "lm-coded")
    name = f"lm_coded_{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, "chunk").saveAsTable(name)
    table = spark.table(name)
    table.schema  # noqa: B018 - resolved before the name goes
    spark.sql(f"DROP TABLE {name}")
    return table


def score_documents(docs: DataFrame, states: int = STATES, own: int = OWN_FROM, shared: int = SHARED) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row per document,
    learnt from those whose crc32(doc_id) mod 10 is not 0."""
    texts = docs.select(
        F.col("doc_id").cast("bigint"), (doc_remainder(F.col("doc_id"), FOLDS) == 0).alias("held"), "text"
    )
    spark = docs.sparkSession
    with _shuffles_freed(spark):
        chunks = written(texts.mapInArrow(_cut, _CHUNKS), "lm-chunks")
        n_chunks = max(1, chunks.count())
        slices = -(-n_chunks // FAN)
        vocabulary = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("number", "w")).select(
            "chunk", "number", F.col("w.words").alias("word"), F.col("w.counts").alias("n")
        )
        counts = written(vocabulary.groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")
        size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
        classes = classed_tokens(counts, max(1, own), shared)
        found = vocabulary.select(F.col("chunk").alias("own"), "number", "word").join(
            classes.words.hint("shuffle_hash"), "word"  # one row a word, so parts are small and even
        ).drop("word")
        coded = _by_chunk(
            chunks.drop("words", "counts").groupBy("chunk").cogroup(found.groupBy("own"))
            .applyInPandas(_code(size.n, size.v, classes.mass, shared, slices), _CODED),
            min(MOST_BUCKETS, 2 * n_chunks),
        )
        _discard(chunks)
        found, weights = train(coded, classes, slices, states)
    model = spark.sparkContext.broadcast(found)

    def score(chunks: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        row, q = chunks.iloc[0], model.value.of(own)
        logs = log_likelihoods(q, *_of(row)) / np.log(10)
        ids = pd.array(row["docs"], dtype="Int64")
        ids[~np.asarray(row["named"], dtype=bool)] = pd.NA
        return pd.DataFrame({
            "doc_id": ids, "held_out": row["held"], "n_tokens": row["sizes"], "n_known": row["known"],
            "base_score": row["base"], "score": logs + row["inside"],
        })

    sent = _sent(coded, weights, slices, states).groupBy("chunk")
    scored = coded.drop("parts", "asks", "slice").groupBy("chunk").cogroup(sent).applyInPandas(score, _SCORED)
    return scored.withColumn("train_tokens", F.lit(size.n).cast("bigint"))
