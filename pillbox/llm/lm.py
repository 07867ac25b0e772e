"""LM scoring: a small causal self-attention model over subword ids, in numpy.

Subwords are the first ``VOCAB`` entries of a public byte-level BPE table,
word by word, each with its leading space and its trailing marks apart.  The model has one head over
``CONTEXT`` tokens with a learned bias per distance, and a two-level output
(class, then member) whose starting biases are the subword counts of all
training documents.  It is trained in rounds: tasks improve the weights on
their own documents with Adam, and the weights are averaged, in slices, by
executors.  Every run of ``RUN`` words of every training document is trained on
once: round r takes the runs r modulo ``ROUNDS``, counted over a task's texts.

Scoring cuts a text into blocks.  Each block's queries see the block before
and their own, masked causally; so windows overlap and each token is scored once.

Beside it stands a unigram baseline over words with add-one counts.  The
``FREQUENT`` most frequent words are resolved where the text is; only the
others are shuffled, by word, so no word is a hot key.
"""

from __future__ import annotations

import base64
import math
from array import array
from collections import Counter
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pillbox.llm.common import materialise, slices

VOCAB, CLASS = 4096, 64  # subwords; members of an output class
CLASSES = VOCAB // CLASS + 1  # the last class holds the end of a text
END, START = VOCAB, VOCAB + 1
LAST_OF_TEXT, FIRST = (array("h", [i]).tobytes() for i in (END, START))  # as in Paths
BLOCK = 16
CONTEXT = 2 * BLOCK
WIDTH = 16
FREQUENT = 1 << 18  # words with counts sent to all tasks
RUN = 32  # words
ROUNDS, STEP_TOKENS, RATE = 2, 1024, 0.01  # the rounds share the runs of words among them: one epoch
SCORE_BLOCKS = 256
TOP = 80.0  # logits are cut here, in training as in scoring, so that no exponential overflows
SEED = 11
LAST = (1 << 63) - 1
MARKS = b".,;:!?"
REMEMBERED = 500_000  # words whose subwords a Python worker keeps; beyond that it starts anew


class Paths(dict):
    """Ids (int16, as bytes) of words, each with the space before it; made when first asked for."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        core = word.rstrip(MARKS)
        if core and core != word:  # marks behind a word are encoded apart from it
            found = self[core] + self.pieces(word[len(core) :])
        else:
            found = self.pieces(b" " + word)
        self[word] = found
        return found

    def pieces(self, text: bytes) -> bytes:
        ids = []
        for i in range(0, len(text), 1000):  # a very long "word" is encoded in pieces: BPE takes quadratic time
            ids += self.encode(text[i : i + 1000])
        return array("h", ids).tobytes()


class Subwords:
    """Byte-level BPE of the first entries of a rank table, word by word; the table is never trained or changed."""

    def __init__(self, lines: list[tuple[str, int]]):
        import tiktoken

        self.lines = lines
        ranks = {base64.b64decode(a): b for a, b in lines}
        bpe = tiktoken.Encoding("subwords", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        self.cache = Paths(bpe._encode_bytes)
        self.word = self.cache.__getitem__

    @classmethod
    def load(cls, path: str) -> Subwords:
        with open(path, encoding="ascii") as f:
            pairs = (line.split() for line in f)
            return cls([(a, int(b)) for a, b in pairs if int(b) < VOCAB])

    def __reduce__(self):
        return known_subwords, (tuple(self.lines),)


@lru_cache(maxsize=1)
def known_subwords(lines: tuple[tuple[str, int], ...]) -> Subwords:
    """The same for all passes of a Python worker: paths found in one serve the next."""
    return Subwords(list(lines))


Pair = tuple[np.ndarray, np.ndarray]


def whole(ids: np.ndarray) -> Pair:
    """Inputs and targets of a text."""
    return np.concatenate([[START], ids]), np.concatenate([ids, [END]])


def blocks_of(pairs: list[Pair]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, first, number): the blocks of all pairs; targets are padded with -1, first marks a pair's start."""
    counts = np.array([(len(t) + BLOCK - 1) // BLOCK for _, t in pairs], np.int64)
    total = int(counts.sum())
    x, y = np.zeros((total, BLOCK), np.intp), np.full((total, BLOCK), -1, np.intp)
    fx, fy = x.ravel(), y.ravel()
    first = np.zeros(total, bool)
    first[np.cumsum(counts) - counts] = True
    at = 0
    for (inputs, targets), c in zip(pairs, counts.tolist()):
        fx[at : at + len(inputs)] = inputs
        fy[at : at + len(targets)] = targets
        at += c * BLOCK
    return x, y, first, np.repeat(np.arange(len(pairs)), counts)


_distance = np.clip(np.arange(BLOCK)[:, None] + BLOCK - np.arange(CONTEXT)[None, :], 0, CONTEXT - 1)
_mask = np.where(np.arange(CONTEXT)[None, :] <= np.arange(BLOCK)[:, None] + BLOCK, 0, -1e9).astype(np.float32)
_mask_first = np.where(np.arange(CONTEXT)[None, :] < BLOCK, -1e9, _mask).astype(np.float32)


def initial(unigrams: np.ndarray) -> dict[str, np.ndarray]:
    """Weights whose prediction is the (add-one) distribution of the counted subwords."""
    rng = np.random.default_rng(SEED)
    normal = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    p = np.full((CLASSES, CLASS), 1e-30)
    p[:-1] = (unigrams[:VOCAB] + 1).reshape(-1, CLASS)
    p[-1, 0] = unigrams[END] + 1
    by_class = p.sum(axis=1)
    return {
        "table": normal(VOCAB + 2, 4 * WIDTH),  # query, key, value and own part of every token
        "near": np.zeros(CONTEXT, np.float32),
        "to_class": normal(WIDTH, CLASSES),
        "class_bias": np.log(by_class / by_class.sum()).astype(np.float32),
        "to_member": normal(CLASSES, WIDTH, CLASS),
        "member_bias": np.log(p / by_class[:, None]).astype(np.float32),
    }


def cut(z):
    """Nothing over ``TOP``.  To see that there is nothing takes a seventh of the time that cutting does."""
    return z if z.max(initial=0) <= TOP else np.minimum(z, TOP, out=z)


def attend(w, x, first):
    """(queries, keys, values, unnormalised weights, their sums, mixed values, hidden state); keys and values of a block and the one before."""
    z = w["table"].take(np.concatenate([x[-1:], x]), axis=0)
    # block b with block b + 1: overlapping views, no copy
    k2, v2 = (np.ndarray((len(x), CONTEXT, WIDTH), z.dtype, z, i * WIDTH * z.itemsize, z.strides) for i in (1, 2))
    q = z[1:, :, :WIDTH] * np.float32(WIDTH**-0.5)
    s = np.matmul(q, k2.transpose(0, 2, 1))
    s += (w["near"][_distance] + _mask).astype(s.dtype)
    s[first] += _mask_first
    np.exp(cut(s), out=s)
    total = (s.reshape(-1, CONTEXT) @ np.ones(CONTEXT, s.dtype)).reshape(len(x), BLOCK, 1)  # a token sees itself: not 0
    mixed = np.matmul(s, v2)
    mixed /= total
    h = mixed + z[1:, :, 3 * WIDTH :]
    return q, k2, v2, s, total, mixed, np.maximum(h, 0, out=h)


def with_biases(w) -> Pair:
    """Weights of the classes and of the members, their biases behind them: they ride in the products."""
    return np.vstack([w["to_class"], w["class_bias"]]), np.concatenate([w["to_member"], w["member_bias"][:, None, :]], axis=1)


def by_class(h, y):
    """The real targets, class by class.

    (their places, their hidden states with a one behind, class of each, member of each, room for the logits of members,
    (class, its hidden states, its room, from, to) of every class present.)
    """
    y = y.ravel()
    real = np.flatnonzero(y >= 0)
    order = real[np.argsort((y[real] // CLASS).astype(np.int16), kind="stable")]
    y = y[order]
    groups = y // CLASS
    hidden = np.ones((len(order), WIDTH + 1), h.dtype)
    hidden[:, :WIDTH] = h.reshape(-1, WIDTH).take(order, axis=0)
    bounds = np.searchsorted(groups, np.arange(CLASSES + 1)).tolist()
    room = np.empty((len(order), CLASS), h.dtype)
    spans = [(c, hidden[i:j], room[i:j], i, j) for c, (i, j) in enumerate(zip(bounds, bounds[1:])) if i < j]
    return order, hidden, groups, y - groups * CLASS, room, spans


def exps(z, k):
    """(logits at the columns k, sums of a row's exponentials); z becomes the exponentials."""
    own = cut(z)[np.arange(len(z)), k]
    np.exp(z, out=z)
    return own, z @ np.ones(z.shape[1], z.dtype)


def member_logits(to_member, room, spans):
    for c, hidden, z, _, _ in spans:
        np.dot(hidden, to_member[c], out=z)
    return room


def score_blocks(w, x, y, first, biased: Pair | None = None) -> np.ndarray:
    """Natural-log probability of every target; 0 for padding.  ``biased`` is ``with_biases(w)``, if at hand."""
    to_class, to_member = biased or with_biases(w)
    order, hidden, groups, members, room, spans = by_class(attend(w, x, first)[-1], y)
    own, sums = exps(hidden @ to_class, groups)
    own_member, member_sums = exps(member_logits(to_member, room, spans), members)
    out = np.zeros(y.size, np.float64)
    out[order] = own - np.log(sums) + (own_member - np.log(member_sums))
    return out


class Dense:
    """One array for the arrays given, of their shapes, and the arrays as parts of it."""

    def __init__(self, near, to_class, to_member):
        self.flat = np.concatenate([a.ravel() for a in (near, to_class, to_member)])
        cuts = np.cumsum([near.size, to_class.size])
        self.near, self.to_class, self.to_member = (v.reshape(a.shape) for v, a in zip(np.split(self.flat, cuts), (near, to_class, to_member)))
        self.members = list(self.to_member)  # views, made once
        self.without_biases = [m[:WIDTH].T for m in self.members]


def row_gradients(w, dense: Dense, into: Dense, x, y, first):
    """(gradients of the table's rows in use, their ids, loss), as means; those of near, to_class and to_member with biases go to ``into``."""
    to_class = dense.to_class
    q, k2, v2, s, total, mixed, h = attend(w, x, first)
    order, hidden, groups, members, room, spans = by_class(h, y)
    n, at = max(1, len(order)), np.arange(len(order))
    # both softmaxes stay unnormalised: what their sums divide is the narrow side of each product
    e = hidden @ to_class
    own, sums = exps(e, groups)
    loss = np.log(sums).sum(dtype=float) - own.sum(dtype=float)
    e[at, groups] -= sums
    part = (1 / (sums * n)).astype(h.dtype)[:, None]
    np.matmul((hidden * part).T, e, out=into.to_class)
    dh = e @ to_class[:WIDTH].T
    dh *= part
    e = member_logits(dense.members, room, spans)
    own, sums = exps(e, members)
    loss += np.log(sums).sum(dtype=float) - own.sum(dtype=float)
    e[at, members] -= sums
    part = (1 / (sums * n)).astype(h.dtype)[:, None]
    hidden *= part
    dm = np.empty_like(dh)
    into.to_member.fill(0)
    for c, own_hidden, own_e, i, j in spans:
        np.dot(own_hidden.T, own_e, out=into.members[c])
        np.dot(own_e, dense.without_biases[c], out=dm[i:j])
    dm *= part
    dh += dm
    dz = np.zeros_like(h)
    dz.reshape(-1, WIDTH)[order] = dh
    dz *= h > 0
    dt = dz / total
    ds = np.matmul(dt, v2.transpose(0, 2, 1))
    ds -= np.einsum("btw,btw->bt", dt, mixed)[:, :, None]
    ds *= s
    into.near[:] = np.bincount(_distance.ravel(), weights=ds.sum(axis=0).ravel(), minlength=CONTEXT)
    d2 = np.empty((len(x), CONTEXT, 2 * WIDTH), h.dtype)  # of keys and values
    np.matmul(ds.transpose(0, 2, 1), q, out=d2[:, :, :WIDTH])  # q is scaled already
    np.matmul(s.transpose(0, 2, 1), dt, out=d2[:, :, WIDTH:])
    rows = np.empty((len(x), BLOCK, 4 * WIDTH), h.dtype)
    np.matmul(ds, k2, out=rows[:, :, :WIDTH])
    np.add(d2[:-1, BLOCK:], d2[1:, :BLOCK], out=rows[:-1, :, WIDTH : 3 * WIDTH])
    np.add(d2[-1, BLOCK:], d2[0, :BLOCK], out=rows[-1, :, WIDTH : 3 * WIDTH])
    rows[:, :, 3 * WIDTH :] = dz
    ids = x.ravel()
    order = np.argsort(ids.astype(np.int16), kind="stable")
    ids = ids[order]
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    rows = rows.reshape(-1, 4 * WIDTH).take(order, axis=0)
    twos = rows.view(np.result_type(rows, np.complex64))  # numpy adds up half as many numbers of two parts in under half the time
    table = np.add.reduceat(twos, starts).view(rows.dtype)
    table[:, :WIDTH] *= np.float32(WIDTH**-0.5)
    return table, ids[starts], loss / n


def gradients(w, x, y, first) -> tuple[dict[str, np.ndarray], float]:
    """Mean gradients of the negative log likelihood of the targets, and its mean."""
    dense = Dense(w["near"], *with_biases(w))
    into = Dense(dense.near, dense.to_class, dense.to_member)
    rows, ids, loss = row_gradients(w, dense, into, x, y, first)
    table = np.zeros_like(w["table"])
    table[ids] = rows
    return {"table": table, **parts(into)}, loss


def parts(d: Dense) -> dict[str, np.ndarray]:
    return {"near": d.near, "to_class": d.to_class[:WIDTH], "class_bias": d.to_class[WIDTH], "to_member": d.to_member[:, :WIDTH], "member_bias": d.to_member[:, WIDTH]}


class Adam:
    """Adam; of the table only the rows of the tokens at hand move.  All other weights lie in one array and move together."""

    def __init__(self, w):
        self.dense = Dense(w["near"], *with_biases(w))
        self.found = Dense(self.dense.near, self.dense.to_class, self.dense.to_member)  # gradients
        self.w, self.t = {"table": w["table"], **parts(self.dense)}, 0
        # values, means, squares
        self.moving, self.table = ([a, np.zeros_like(a), np.zeros_like(a)] for a in (self.dense.flat, w["table"]))

    def step(self, x, y, first) -> float:
        table, ids, loss = row_gradients(self.w, self.dense, self.found, x, y, first)
        self.t += 1
        self.move(*self.moving, self.found.flat)
        rows = [a.take(ids, axis=0) for a in self.table]
        self.move(*rows, table)
        for a, r in zip(self.table, rows):
            a[ids] = r
        return loss

    def move(self, w, m, v, d):
        """In place; d is used up."""
        scale = math.sqrt(1 - 0.99**self.t)
        d *= np.float32(0.1)
        m *= np.float32(0.9)
        m += d
        d *= d
        v *= np.float32(0.99)
        v += d
        np.sqrt(v, out=d)
        d += np.float32(1e-6 * scale)
        np.divide(m, d, out=d)
        d *= np.float32(RATE * scale / (1 - 0.9**self.t))
        w -= d


def lesson(data: bytes, subwords: Subwords, seen: int, round_: int) -> tuple[list[Pair], int]:
    """The text's runs of ``RUN`` words, counted on from ``seen``, that the round takes: their subwords as pairs."""
    words = data.lower().split()
    n = len(words) // RUN + 1
    pairs = []
    path = subwords.cache.__getitem__
    for r in range((round_ - seen) % ROUNDS, n, ROUNDS):
        a, b = r * RUN, min((r + 1) * RUN, len(words))
        before = path(words[a - 1])[-2:] if a else FIRST
        ids = np.frombuffer(b"".join([before, *map(path, words[a:b]), LAST_OF_TEXT if r == n - 1 else b""]), np.int16)
        pairs.append((ids[:-1], ids[1:]))
    return pairs, seen + n


def joined(words: list[bytes], subwords: Subwords) -> np.ndarray:
    return np.frombuffer(b"".join(map(subwords.cache.__getitem__, words)), np.int16)


def subword_ids(data: bytes, subwords: Subwords) -> np.ndarray:
    return joined(data.lower().split(), subwords)  # bytes: A-Z, and \x20 \x09-\x0D only


def texts_of(batch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def word_counts(train: DataFrame) -> DataFrame:
    """(word, n) over all training texts; the empty word stands for the end of a text."""

    def count(batches):
        found: Counter[bytes] = Counter()
        for b in slices(batches):
            for t in texts_of(b):
                found.update(t.lower().split())
            found[b""] += b.num_rows
            if len(found) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])
                found = Counter()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    return train.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_from(counts: DataFrame) -> int:
    """A count that at most ``FREQUENT`` words reach, from a histogram of 8 steps for each doubling."""
    steps = counts.groupBy(F.floor(F.log2("n") * 8).cast("int").alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).collect()
    words, least = 0, LAST
    for r in sorted(steps, key=lambda r: -r["step"]):
        words += r["words"]
        if words > FREQUENT:
            break
        least = r["least"]
    return least


def subword_counts(counts: DataFrame, subwords: Subwords) -> np.ndarray:
    """How often each subword occurs in the counted words; VOCAB + 2 numbers."""

    def count(batches):
        sums = np.zeros(VOCAB + 2, np.int64)
        for b in slices(batches):
            paths = [subwords.word(word) if word else LAST_OF_TEXT for word in b.column("word").to_pylist()]
            n = np.repeat(b.column("n").to_numpy(), [len(p) // 2 for p in paths])
            np.add.at(sums, np.frombuffer(b"".join(paths), np.int16), n)
        ids = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sums[ids])], names=["id", "n"])

    out = np.zeros(VOCAB + 2, np.int64)
    for r in counts.mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


def flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)])


def unflat(v: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = v[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


SLICE = 1 << 14  # weights that are averaged together


def train_round(train: DataFrame, weights: dict[str, np.ndarray], subwords: Subwords, round_: int) -> dict[str, np.ndarray]:
    """Tasks go on from the weights, each over its own texts; the results are averaged, weighted by tokens."""
    shared = train.sparkSession.sparkContext.broadcast((weights, subwords))

    def run(batches):
        from pyspark import TaskContext

        given, pieces = shared.value
        adam = Adam({k: v.copy() for k, v in given.items()})
        held: list[Pair] = []
        seen, tokens, waiting = 0, 0, 0

        def step():
            x, y, first, _ = blocks_of(held)
            adam.step(x, y, first)
            held.clear()
            return int((y >= 0).sum())

        for b in slices(batches, 64):
            pairs = []  # of all texts first: words are looked up faster while the steps' arrays are not in between
            for t in texts_of(b):
                found, seen = lesson(t, pieces, seen, round_)
                pairs += found
            for pair in pairs:
                held.append(pair)
                waiting += len(pair[1])
                if waiting >= STEP_TOKENS:
                    tokens += step()
                    waiting = 0
        if held:
            tokens += step()
        if tokens:
            v = flat(adam.w).astype(np.float64) * tokens
            cuts = range(0, len(v), SLICE)
            part = TaskContext.get().partitionId() % 64
            yield pa.RecordBatch.from_arrays(
                [pa.array([i // SLICE for i in cuts], pa.int32()), pa.array([part] * len(cuts), pa.int32()), pa.array([tokens] * len(cuts), pa.int64()), pa.array([v[i : i + SLICE].tobytes() for i in cuts], pa.binary())],
                names=["slice", "part", "tokens", "v"],
            )

    schema = "slice int, part int, tokens bigint, v binary"

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[:1].assign(tokens=pdf.tokens.sum(), v=[reduce(np.add, (np.frombuffer(v) for v in pdf.v)).tobytes()])

    parts = train.select("text").mapInArrow(run, schema)
    sums = parts.groupBy("slice", "part").applyInPandas(add, schema).groupBy("slice").applyInPandas(add, schema).collect()  # the weights
    if not sums:
        return weights
    v = np.concatenate([np.frombuffer(bytes(r["v"])) / r["tokens"] for r in sorted(sums, key=lambda r: r["slice"])])
    return unflat(v, weights)


SCORED = "row bigint, held_out boolean, tokens bigint, known bigint, base double, score double, word binary, n bigint"


def score_texts(shared):
    """mapInArrow function: a row for each text, then one for each of its words whose count is not at hand."""
    names = ["id", *(c.split()[0] for c in SCORED.split(", "))]
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64())

    def rows(ids, columns):
        return pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)

    def run(batches):
        from pyspark import TaskContext

        weights, pieces, frequent = shared.value
        biased = with_biases(weights)
        row = TaskContext.get().partitionId() << 40
        for b in slices(batches, 128):
            texts = texts_of(b)
            heads, rare, split = [], ([], [], []), []
            for t in texts:
                words = t.lower().split()
                split.append(words)
                at_hand = list(map(frequent.get, [*words, b""]))  # None, or the logarithm of a number under 1
                if None in at_hand:
                    others = Counter(w for w, v in zip([*words, b""], at_hand) if v is None)
                    rare[0].extend([row] * len(others))
                    rare[1].extend(others)
                    rare[2].extend(others.values())
                    at_hand = [v for v in at_hand if v is not None]
                heads.append((row, len(words) + 1, len(at_hand), math.fsum(at_hand)))
                row += 1
            x, y, first, text = blocks_of([whole(joined(words, pieces)) for words in split])
            score = np.zeros(len(texts))
            for i in range(0, len(x), SCORE_BLOCKS):
                lo = max(0, i - 1)  # the block before is context
                s = slice(lo, i + SCORE_BLOCKS)
                p = score_blocks(weights, x[s], np.where((np.arange(lo, min(i + SCORE_BLOCKS, len(x))) < i)[:, None], -1, y[s]), first[s], biased)
                score += np.bincount(np.repeat(text[s], BLOCK), weights=p, minlength=len(texts))
            number, tokens, known, base = zip(*heads)
            none = [None] * len(heads)
            yield rows(b.column("id"), (number, b.column("held_out").to_pylist(), tokens, known, base, score / np.log(10), none, none))
            if rare[0]:
                none = [None] * len(rare[0])
                yield rows(pa.nulls(len(none), b.column("id").type), (rare[0], none, none, none, none, none, rare[1], rare[2]))

    return run


def lm_score(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_fold: int = 2) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    A row is held out of all training if crc32 of its id as text, modulo
    ``folds``, is ``held_fold`` (a null id counts as empty text).  A null or
    empty text is an end alone.  ``score`` is the log10 probability that the
    attention model gives the text's subwords and their end; ``base_score``
    that of its words and their end by add-one counts.  Without any training
    row all counts are 0 and the model predicts evenly.  Only the two named
    columns are read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == held_fold
    src = docs.select(F.col(id_col).alias("id"), held.alias("held_out"), F.col(text_col).alias("text"))
    train = src.where("not held_out")
    subwords = Subwords.load(vocabulary)
    counts = materialise(word_counts(train), "lm-words")
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("words")).first()
    floor = float(totals.tokens + totals.words + 1)
    top = counts.where(F.col("n") >= frequent_from(counts)).collect()  # FREQUENT rows at most
    frequent = {bytes(r["word"]): float(np.log10((r["n"] + 1) / floor)) for r in top}
    weights = initial(subword_counts(counts, subwords))
    for r in range(ROUNDS):
        weights = train_round(train, weights, subwords, r)
    shared = spark.sparkContext.broadcast((weights, subwords, frequent))
    kind = src.schema["id"].dataType.simpleString()
    scored = materialise(src.mapInArrow(score_texts(shared), f"id {kind}, {SCORED}"), "lm-scores")
    looked_up = scored.where("word is not null").join(counts.withColumnRenamed("n", "c"), "word", "left")
    rare = looked_up.select("row", F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0).alias("known"), (F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(floor))).alias("base"))
    rare = rare.groupBy("row").agg(F.sum("known").alias("rare_known"), F.sum("base").alias("rare_base"))
    heads = scored.where("word is null").join(rare, "row", "left")
    return heads.select(
        F.col("id").alias(id_col), "held_out", F.col("tokens").alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(totals.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "score",
    )
