"""Phrase collocations by broadcast double-array tries.

1. Words are counted by language; the frequent ones get numbers, and every text becomes an array of them (0 for a rare
   word or the end of a piece: no frequent phrase holds either).
2. Level by level, phrases of k + 1 words are candidates only where their first k and their last k words are frequent.
   A trie of the frequent phrases of k words is broadcast and all text positions advance in it at once; two neighbouring
   positions that both arrive make a candidate.  Tasks send each candidate once with a count that stops at ``min_count``:
   the sum of these reaches ``min_count`` if and only if the true count does.
3. The candidates of all levels make the last tries.  All positions advance word by word, the states that accept are
   counted with ``bincount``, and the counts of the tasks are summed.  From these come a, l and r.

A trie is a double array: the child of state s by digit w is slot base[s] + w, if check of that slot is s; a word is two
digits or so.  A trie holds
about ``TRIE`` phrases; more of them become several tries (by their first two words) and as many passes over the
numbered texts.  Words are numbered in the same way, ``VOCABULARY`` of them at a time.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pillbox.llm.common import LOWER, UPPER, materialise, slices, slices_of_bytes

VOCABULARY = 1 << 20  # words of one broadcast
TRIE = 1 << 20  # phrases of one broadcast, on average
HELD = 1 << 18  # distinct words a task counts before it sends them
PAIRS = 1 << 20  # candidates a task holds before it sends them
POSITIONS = 1 << 18  # text positions that advance at once
DIGIT = 10  # bits of a step in a trie
WIDE = 1 << DIGIT  # children of a node at most
SENT = 1 << 16  # rows of a record batch
SALTS = 64
LONGEST = 4
STOP = b"."  # any end of a piece; no word holds it
TABLE = bytes.maketrans((UPPER + ",;:!?\n\x0b\x0c\r\t").encode(), (LOWER + "........." + " ").encode())


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, with ``STOP`` between pieces."""
    return text.translate(TABLE).replace(STOP, b" . ").split()


def count_words(batches):
    """mapInArrow function: (lang, text) -> (lang, word, n), partial counts."""

    def sent(counts):
        for lang, words in counts.items():
            words.pop(STOP, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())],
                names=["lang", "word", "n"],
            )

    counts: dict[str, Counter] = {}
    for b in slices_of_bytes(batches, "text"):
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
            counts.setdefault(lang, Counter()).update(tokens(text))
        if sum(map(len, counts.values())) > HELD:
            yield from sent(counts)
            counts = {}
    yield from sent(counts)


def number_texts(vocabulary, keep_text: bool):
    """mapInArrow function: adds the numbers of this broadcast's words to ``ids`` (int32, one 0 behind each text)."""

    def run(batches):
        numbers = vocabulary.value
        for b in slices_of_bytes(batches, "text"):
            langs, before, ids = b.column("lang").to_pylist(), b.column("ids").to_pylist(), []
            texts = b.column("text").cast(pa.binary()).to_pylist()
            for lang, text, old in zip(langs, texts, before):
                known, ws = numbers.get(lang, {}), tokens(text)
                new = np.zeros(len(ws) + 1, np.int32)
                new[:-1] = [known.get(w, 0) for w in ws]
                ids.append((new if old is None else new + np.frombuffer(old, np.int32)).tobytes())
            text = b.column("text") if keep_text else pa.nulls(b.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([b.column("lang"), text, pa.array(ids, pa.binary())], names=["lang", "text", "ids"])

    return run


class Trie:
    """Double array over rows of word numbers; see the module text.

    Words get local numbers 1, 2, ..., and each is ``digits`` steps of ``DIGIT`` bits, so that no node has many children:
    wide nodes find a base whose slots are all free, or take new slots; nodes with one child fill what is left free.
    """

    def __init__(self, levels: list[np.ndarray]):
        """``levels``: for 2, 3, ... words the phrases as rows; every row's beginning is a row of the level before."""
        self.words = np.unique(np.concatenate([x.ravel() for x in levels])) if levels else np.zeros(0, np.int64)
        self.digits = max(1, -(-len(self.words).bit_length() // DIGIT))
        self.base, self.check = np.zeros(WIDE + 1, np.int32), np.full(WIDE + 1, -1, np.int32)
        self.depth = 1 + len(levels)
        rng = np.random.default_rng(0)
        for k, rows in enumerate(levels):
            local = np.searchsorted(self.words, rows) + 1
            if k == 0:
                first = np.unique(local[:, 0])
                begun = np.zeros(len(self.words) + 1, np.int64)
                begun[first] = self._extend(np.zeros(len(first), np.int64), first, rng)
                parent = begun[local[:, 0]]
            else:
                parent = slots[np.searchsorted(keys, self._keys(local[:, :-1]))]
            slot = self._extend(parent, local[:, -1], rng)
            keys = self._keys(local)
            order = np.argsort(keys)
            keys, slots = keys[order], slot[order]
        self._grow(len(self.base) + WIDE)
        self.size = len(self.base)

    def _keys(self, local: np.ndarray) -> np.ndarray:
        """One sortable value for each row of local numbers."""
        if local.shape[1] * len(self.words).bit_length() < 63:
            key = np.zeros(len(local), np.int64)
            for column in local.T:
                key = key * (len(self.words) + 1) + column
            return key
        return np.ascontiguousarray(local.astype(">i4")).view(f"V{4 * local.shape[1]}").ravel()

    def _digits(self, local: np.ndarray):
        for d in reversed(range(self.digits)):
            yield local >> DIGIT * d & WIDE - 1

    def _extend(self, parent: np.ndarray, word: np.ndarray, rng) -> np.ndarray:
        """The slots of these words behind these states; all children that a state gets come in one call."""
        for digit in self._digits(word):
            edges, at = np.unique(parent.astype(np.int64) << DIGIT | digit, return_inverse=True)
            parent = self._place(edges >> DIGIT, edges & WIDE - 1, rng)[at]
        return parent

    def _place(self, parent: np.ndarray, digit: np.ndarray, rng) -> np.ndarray:
        """A base for each parent such that its children fall on free slots; gives the children's slots."""
        first = len(self.base)
        starts = np.flatnonzero(np.diff(parent, prepend=-1))
        sizes = np.diff(np.append(starts, len(parent)))
        self._grow(first + 2 * int(sizes[sizes > 1].sum()) + WIDE)
        slot = np.zeros(len(parent), np.int64)

        def settle(nodes, base):
            """Give these nodes their bases where all their slots are free and no earlier node wants one of them."""
            child = np.repeat(starts[nodes] - np.cumsum(sizes[nodes]) + sizes[nodes], sizes[nodes]) + np.arange(sizes[nodes].sum())
            group = np.repeat(np.arange(len(nodes)), sizes[nodes])
            at = base[group] + digit[child]
            owner = np.full(len(self.base), -1, np.int32)
            owner[at[::-1]] = group[::-1]
            fits = np.bincount(group, (owner[at] == group) & (self.check[at] == -1), minlength=len(nodes)) == sizes[nodes]
            good = fits[group]
            slot[child[good]] = at[good]
            self.check[at[good]] = parent[child[good]]
            self.base[parent[starts[nodes[fits]]]] = base[fits]
            return nodes[~fits]

        for least in (64, 16, 4, 2):
            todo = np.flatnonzero((sizes >= least) & (slot[starts] == 0))
            for turn in range(8 if least > 4 else 1 << 30):
                if not len(todo):
                    break
                todo = settle(todo, rng.integers(first - 1, len(self.base) - WIDE, len(todo)))
                if turn % 8 == 7 and least <= 4:  # narrow nodes get more room
                    self._grow(len(self.base) + 2 * int(sizes[todo].sum()))
            if len(todo):  # and wide ones new slots
                low, high = digit[starts[todo]], digit[starts[todo] + sizes[todo] - 1]
                begin = len(self.base) + np.cumsum(high - low + 1) - (high - low + 1)
                self._grow(int(begin[-1]) + WIDE)
                settle(todo, begin - low)
        alone = np.flatnonzero(sizes == 1)
        free = first + np.flatnonzero(self.check[first:] == -1)
        if len(free) < len(alone):
            more = np.arange(len(self.base), len(self.base) + len(alone) - len(free))
            self._grow(int(more[-1]) + 1)
            free = np.append(free, more)
        at = free[: len(alone)]
        slot[starts[alone]] = at
        self.check[at] = parent[starts[alone]]
        self.base[parent[starts[alone]]] = at - digit[starts[alone]]
        return slot

    def _grow(self, size: int) -> None:
        more = max(0, size - len(self.base))
        self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
        self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])

    def start(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Local numbers of the text positions (0 for a word of no phrase), with room behind them, and the states after one word."""
        local = np.zeros(len(ids) + LONGEST, np.int32)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, ids), len(self.words) - 1)
            local[: len(ids)] = np.where(self.words[at] == ids, at + 1, 0)
        alive = np.flatnonzero(local)
        return local, self._step(np.zeros(len(alive), np.int32), alive, local, 0, len(ids))

    def _step(self, now: np.ndarray, alive: np.ndarray, local: np.ndarray, depth: int, n: int) -> np.ndarray:
        for d in reversed(range(self.digits)):
            to = self.base[now] + (local[alive + depth] >> DIGIT * d & WIDE - 1)
            ok = self.check[to] == now
            now, alive = to[ok], alive[ok]
        out = np.zeros(n, np.int32)
        out[alive] = now
        return out

    def advance(self, state: np.ndarray, local: np.ndarray, depth: int) -> np.ndarray:
        """The states of all positions after word ``depth`` (0 behind the first); 0 where none is left."""
        alive = np.flatnonzero(state)
        return self._step(state[alive], alive, local, depth, len(state))

    def spelled(self, slots: np.ndarray) -> np.ndarray:
        """The word numbers on the way to the slots as rows of ``LONGEST``, 0 behind the phrase's end."""
        back = np.zeros((len(slots), LONGEST + 1), np.int64)  # last word first
        now, here = slots.astype(np.int64), np.arange(len(slots))
        for k in range(LONGEST):
            for d in range(self.digits):
                before = self.check[now].astype(np.int64)
                back[here, k] |= now - self.base[before] << DIGIT * d
                now = before
            some = now > 0
            now, here = now[some], here[some]
        depth = np.count_nonzero(back, axis=1)
        place = depth[:, None] - 1 - np.arange(LONGEST)
        local = back[np.arange(len(slots))[:, None], np.where(place >= 0, place, LONGEST)]
        return np.append(0, self.words)[local]


def packed(rows: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows of four word numbers as two longs, and a count."""
    a, b = rows[:, 0] << 32 | rows[:, 1], rows[:, 2] << 32 | rows[:, 3]
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n.astype(np.int64))], names=["a", "b", "n"])


def unpacked(table: pa.Table) -> np.ndarray:
    a, b = (table.column(c).to_numpy() for c in ("a", "b"))
    return np.stack([a >> 32, a & 0xFFFFFFFF, b >> 32, b & 0xFFFFFFFF], axis=1)


def positions(batches):
    """The numbers of many texts at once (a 0 behind each)."""
    held, n = [], 0
    for b in slices(batches):
        for x in b.column("ids").to_pylist():
            held.append(x)
            n += len(x) // 4
            if n >= POSITIONS:
                yield np.frombuffer(b"".join(held), np.int32)
                held, n = [], 0
    if held:
        yield np.frombuffer(b"".join(held), np.int32)


def discover(shared, k: int, least: int, single: bool):
    """mapInArrow function: numbered texts -> candidates of k + 1 words, each with a count of at most ``least`` from here."""

    def of(ids):
        if k == 1:
            i = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            return ids[i].astype(np.int64) << 32 | ids[i + 1]
        trie = shared.value
        local, state = trie.start(ids)
        for depth in range(1, k):
            state = trie.advance(state, local, depth)
        following = np.append(ids, np.zeros(k, np.int32))[k:]
        ok = (state > 0) & (following > 0)
        if single:  # else the last k words may be in another trie
            ok[:-1] &= state[1:] > 0
        i = np.flatnonzero(ok)
        return state[i].astype(np.int64) << 32 | following[i]

    def sent(keys, n):
        for lo in range(0, len(keys), SENT):
            x, m = keys[lo : lo + SENT], np.minimum(n[lo : lo + SENT], least)
            if k == 1:
                rows = np.stack([x >> 32, x & 0xFFFFFFFF, np.zeros_like(x), np.zeros_like(x)], axis=1)
            else:
                rows = shared.value.spelled(x >> 32)
                rows[:, k] = x & 0xFFFFFFFF
            yield packed(rows, m)

    def summed(held):
        keys, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

    def run(batches):
        held = []
        for ids in positions(batches):
            held.append(np.unique(of(ids), return_counts=True))
            if sum(len(x) for x, _ in held) > PAIRS:
                held = [summed(held)]
                if len(held[0][0]) > PAIRS // 2:
                    yield from sent(*held.pop())
        if held:
            yield from sent(*summed(held))

    return run


def count_phrases(shared):
    """mapInArrow function: numbered texts -> partial counts of the phrases of a trie."""

    def run(batches):
        trie = shared.value
        counts, held, n = np.zeros(trie.size, np.int64), [], 0
        for ids in positions(batches):
            local, state = trie.start(ids)
            for depth in range(1, trie.depth):
                state = trie.advance(state, local, depth)
                held.append(state[state > 0])
                n += len(held[-1])
            if n > trie.size:
                counts += np.bincount(np.concatenate(held), minlength=trie.size)
                held, n = [], 0
        if n:
            counts += np.bincount(np.concatenate(held), minlength=trie.size)
        slots = np.flatnonzero(counts)
        for lo in range(0, len(slots), SENT):
            some = slots[lo : lo + SENT]
            yield packed(trie.spelled(some), counts[some])

    return run


def numbered(words: DataFrame) -> tuple[DataFrame, int]:
    """The words with numbers 1, 2, ... in column id, and how many they are."""
    words = materialise(words.withColumn("at", F.monotonically_increasing_id()), "colloc-words")
    part = F.shiftright("at", 33).cast("int")
    sizes = {r.part: r.n for r in words.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a partition
    before, total = [], 0
    for p in sorted(sizes):
        before += [F.lit(p), F.lit(total)]
        total += sizes[p]
    at = F.col("at").bitwiseAND((1 << 33) - 1) + 1
    return words.withColumn("id", at + F.element_at(F.create_map(*before), part) if before else at).drop("at"), total


def tries(levels: list[DataFrame], sizes: list[int]):
    """The tries of these levels' phrases, one after the other."""
    shards = max(1, -(-sum(sizes) // TRIE))
    for shard in range(shards):
        rows = []
        for k, level in enumerate(levels):
            found = level.where(F.pmod(F.xxhash64("a"), F.lit(shards)) == shard) if shards > 1 else level
            rows.append(unpacked(found.select("a", "b").toArrow())[:, : k + 2])
        yield Trie([r for r in rows if len(r)])


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = 30, covered_percent: int = 80, top: int = 2000
) -> DataFrame:
    """The best phrases of 2 to 4 words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and split into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and tabs.
    Of each language n counts the words, a phrase's a all its places within pieces; candidates have a >= ``min_count``.
    A cut behind the first k words gives l = a of the first part, r = a of the rest and floor(2000000 * a / (l + r)); the
    lowest is the score, of equal ones that of the smallest k.  A candidate is dropped if a longer one holds its words in a
    row and has at least ``covered_percent`` of its places.  The first ``top`` by score, then a (both descending), then
    phrase (by bytes) are returned.

    A null language is ``und``; a null, empty or blank text has no words.  Texts are read whole: a task holds about a
    megabyte of them or one longer text.  Repeated rows count each.  Only the two named columns are read, so others may
    have any name.  An empty table, or one without frequent phrases, gives an empty result.
    """
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = materialise(
        src.mapInArrow(count_words, "lang string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n")), "colloc-counts"
    )
    frequent, known = numbered(words.where(F.col("n") >= min_count))
    texts = src.withColumn("ids", F.lit(None).cast("binary"))
    for lo in range(0, max(1, known), VOCABULARY):
        numbers: dict[str, dict[bytes, int]] = {}
        some = frequent.where(F.col("id").between(lo + 1, lo + VOCABULARY)).select("lang", "word", "id").toArrow()
        for lang, word, i in zip(*(some.column(c).to_pylist() for c in ("lang", "word", "id"))):
            numbers.setdefault(lang, {})[word] = i
        last = lo + VOCABULARY >= known
        texts = texts.mapInArrow(number_texts(spark.sparkContext.broadcast(numbers), not last), "lang string, text string, ids binary")
        texts = materialise(texts.select("ids") if last else texts, "colloc-texts")
    table = "a bigint, b bigint, n bigint"
    total = F.sum("n").alias("n")
    levels, sizes = [], []
    for k in range(1, LONGEST):
        found = None
        for trie in tries(levels, sizes) if k > 1 else [None]:
            single = sum(sizes) <= TRIE
            part = texts.mapInArrow(discover(spark.sparkContext.broadcast(trie), k, min_count, single), table)
            found = part if found is None else found.union(part)
        level = materialise(found.groupBy("a", "b").agg(total).where(F.col("n") >= min_count).select("a", "b"), "colloc-level")
        n = level.count()
        if not n:
            break
        levels.append(level)
        sizes.append(n)
    counted = None
    for trie in tries(levels, sizes):
        part = texts.mapInArrow(count_phrases(spark.sparkContext.broadcast(trie)), table)
        counted = part if counted is None else counted.union(part)
    phrases = materialise(counted.groupBy("a", "b").agg(total), "colloc-phrases")
    return best_phrases(phrases, frequent, words, covered_percent, top)


def best_phrases(phrases: DataFrame, frequent: DataFrame, words: DataFrame, covered_percent: int, top: int) -> DataFrame:
    """Scores, the test of longer phrases and the first of each language, by joins on word numbers."""
    low = F.lit(0xFFFFFFFF)
    w = [F.shiftright("a", 32), F.col("a").bitwiseAND(low), F.shiftright("b", 32), F.col("b").bitwiseAND(low)]
    size = sum((x > 0).cast("int") for x in w)
    zero = F.lit(0).cast("bigint")

    def pack(*ids):
        ids = [*ids, *[zero] * (4 - len(ids))]
        return (F.shiftleft(ids[0], 32).bitwiseOR(ids[1])).alias("a"), (F.shiftleft(ids[2], 32).bitwiseOR(ids[3])).alias("b")

    long = phrases.withColumn("w", F.array(*w)).withColumn("size", size)
    single = frequent.select(F.shiftleft("id", 32).alias("a"), zero.alias("b"), "n")
    counts = materialise(phrases.select("a", "b", "n").union(single), "colloc-parts")
    cuts = []
    for k in range(1, LONGEST):
        first, rest = pack(*w[:k]), pack(*w[k:])
        cuts.append(F.when(F.col("size") > k, F.struct(F.lit(k).alias("k"), F.struct(*first).alias("first"), F.struct(*rest).alias("rest"))))
    cut = long.select("a", "b", "n", F.explode(F.filter(F.array(*cuts), lambda c: c.isNotNull())).alias("cut"))
    cut = (
        cut.join(counts.select(F.struct("a", "b").alias("first"), F.col("n").alias("l")), F.col("cut.first") == F.col("first"))
        .join(counts.select(F.struct("a", "b").alias("rest"), F.col("n").alias("r")), F.col("cut.rest") == F.col("rest"))
    )
    exact = "cast(2000000 as decimal(38, 0)) * cast(n as decimal(20, 0)) div cast(l + r as decimal(20, 0))"
    scored = (
        cut.withColumn("score", F.expr(exact)).groupBy("a", "b", "n")
        .agg(F.min(F.struct("score", "cut.k", "l", "r")).alias("best")).select("a", "b", "n", "best.*")
    )
    inside = []
    for start in range(LONGEST - 1):
        for stop in range(start + 2, LONGEST + 1):
            if (start, stop) != (0, LONGEST):
                inside.append(F.when((F.col("size") >= stop) & (F.col("size") > stop - start), F.struct(*pack(*w[start:stop]))))
    covered = (
        long.select("n", F.explode(F.filter(F.array(*inside), lambda c: c.isNotNull())).alias("in"))
        .groupBy("in").agg(F.max("n").alias("longer")).select("in.a", "in.b", "longer")
    )
    wide = lambda c: F.col(c).cast("decimal(20, 0)")
    open_ = (
        scored.join(covered, ["a", "b"], "left")
        .where(F.col("longer").isNull() | (wide("longer") * 100 < wide("n") * covered_percent))
        .join(frequent.select(F.col("id").alias("first_id"), "lang"), F.shiftright("a", 32) == F.col("first_id"))
    )
    order = [F.desc("score"), F.desc("n")]
    some = open_.withColumn("salt", F.pmod(F.xxhash64("a", "b"), F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):  # with ties, which the phrase decides below
        some = some.withColumn("place", F.rank().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= top)
    some = materialise(some.select("lang", "a", "b", "n", "l", "r", "score"), "colloc-best")
    spelled = (
        some.select("a", "b", F.posexplode(F.filter(F.array(*w), lambda x: x > 0)).alias("at", "id"))
        .join(frequent.select("id", F.decode("word", "UTF-8").alias("word")), "id")
        .groupBy("a", "b").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("words"))
    ranked = some.join(spelled, ["a", "b"]).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", F.col("n").alias("a"), "l", "r", F.col("words").alias("n"), "score"
    )
