"""SentencePiece encoding and decoding as a weighted finite-state transducer.

``compile_model`` turns a model file into one machine of flat arrays:

* normaliser: dummy prefix, white space to U+2581, optional squeezing of it;
* pieces: a trie over characters whose accepting states emit a piece, with its
  weight in the tropical semiring (minus its score in a unigram model);
* byte fallback: a character that no piece covers is an arc that emits its bytes;
* for a BPE model an acceptor of neighbouring pieces: a pair has weight 0 if
  merging the joined text yields just these two pieces, else infinity.  A
  sequence is the BPE encoding if and only if all its neighbours pass.

``Machine.encode`` composes this with many words at once: the trie walks from
all their positions in step, which gives the arcs of the lattice, and then the
shortest path is relaxed from left to right.  Words are cut only where no
piece can cross, so the paths of a text's words join to its own.

The machine's size is fixed by the model; tasks get it by closure.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pillbox.llm.common import numbered_columns, numbered_types, others, quoted, slices

META = "▁"
NONE = np.iinfo(np.int64).max
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0  # fixed value: added to the lowest score for an uncovered character
BLOCK = 1 << 17  # characters of distinct words composed at once
CACHED = 400_000  # distinct words whose paths a Python worker remembers; beyond that it starts anew


def merges(text: str, number: dict[str, int], rank: dict[str, float]) -> list[tuple[float, int, int]]:
    """BPE of a text: after each merge its rank, the first and the last symbol; the last entry's symbols are equal and the whole text if it becomes one."""
    parts, out = list(text), []
    while len(parts) > 1:
        best = min(((rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank), default=None)
        if best is None:
            break
        r, i = best
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        out.append((r, number[parts[0]], number[parts[-1]]))
    return out if len(parts) == 1 else []


class Machine:
    """Arrays of the compiled transducer; see the module text."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto.FromString(model)
        trainer, norm = proto.trainer_spec, proto.normalizer_spec
        if trainer.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are weighted machines over pieces")
        if norm.precompiled_charsmap or trainer.treat_whitespace_as_suffix or any(p.type == 4 for p in proto.pieces):
            raise ValueError("character maps, suffix white space and user-defined pieces are not supported")
        self.bpe = trainer.model_type == BPE
        self.known: dict[str, bytes] = {}  # paths of words, in a worker
        self.dummy, self.squeeze = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        self.unk = next(i for i, p in enumerate(proto.pieces) if p.type == 2)
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        self.texts = [p.piece.replace(META, " ").encode() if p.type == 1 else bytes([int(p.piece[3:5], 16)]) if p.type == 6 else b"" for p in proto.pieces]
        if len(self.byte_ids) < 256:
            self.byte_ids = {}
            self.texts[self.unk] = " ⁇ ".encode()
        pieces = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type == 1}
        self.size = len(proto.pieces)
        chars = sorted({c for p in pieces for c in p})
        self.char_code = np.zeros(0x110000, np.int32)  # 0: in no piece
        for k, c in enumerate(chars):
            self.char_code[ord(c)] = k + 1
        self.width = len(chars) + 1
        self.uncovered_weight = UNKNOWN_PENALTY - min(s for _, s in pieces.values())
        self._pairs(pieces, chars)
        self._trie({p: i for p, (i, _) in pieces.items() if not self.bpe or p in self.events}, chars)
        self.weight = np.zeros(self.size + self.width + 1, np.float64)
        if not self.bpe:
            for i, s in pieces.values():
                self.weight[i] = -s
            self.weight[self.size :] = self.uncovered_weight
        # where a text may be cut: before white space, around characters of no piece, and between a word and a mark
        inside = {(a, b) for p in pieces for a, b in zip(p, p[1:])}
        self.cut_meta = not any(b == META and a != META for a, b in inside)
        strange = re.escape("".join(c for c in "\n\r\t" if not self.char_code[ord(c)]))
        border = []  # a mark behind a letter that no piece has before it
        for m in ".,;:!?":
            joined = "".join(sorted(a for a, b in inside if b == m and re.match(r"\w", a)))
            border.append((f"(?<![{re.escape(joined)}])" if joined else "") + f"(?={re.escape(m)})")
        word = rf"{META}*+\w++(?:{'|'.join(border)})"
        self.cutter = re.compile((f"[{strange}]|" if strange else "") + rf"{word}|{META}*+[^{META}{strange}]++|{META}++") if self.cut_meta else None
        del self.events

    def _pairs(self, pieces, chars) -> None:
        """Symbols, and the ranks at which two of them merge; for each piece the steps of its own making."""
        self.events = {}
        number = {p: i for p, (i, _) in pieces.items()}
        for k, c in enumerate(chars):
            number.setdefault(c, self.size + k + 1)  # as an uncovered character
        if not self.bpe:
            return
        order = {s: k for k, s in enumerate(sorted({s for _, s in pieces.values()}, reverse=True))}
        rank = {p: order[s] for p, (_, s) in pieces.items()}
        self.symbols = self.size + self.width + 1
        joined = {number[p[:k]] * self.symbols + number[p[k:]]: rank[p] for p in pieces for k in range(1, len(p)) if p[:k] in number and p[k:] in number}
        self.pair_key = np.array(sorted(joined), np.int64)
        self.pair_rank = np.array([joined[k] for k in self.pair_key.tolist()] + [NONE], np.int64)
        longest = max(map(len, pieces))
        shape = (self.symbols, longest)
        # step k of a piece: the rank of its k-th merge (NONE when it is made), its first and last symbol before that merge
        self.step_rank = np.full(shape, NONE, np.int64)
        self.step_first, self.step_last = np.zeros(shape, np.int32), np.zeros(shape, np.int32)
        own = np.arange(self.symbols, dtype=np.int32)
        self.step_first[:, 0] = self.step_last[:, 0] = own
        for p, (i, _) in pieces.items():
            made = merges(p, number, rank)
            if len(p) > 1 and not made:
                continue  # merging never yields this piece
            self.events[p] = made
            first, last = number[p[0]], number[p[-1]]
            for k, (r, f, z) in enumerate(made):
                self.step_rank[i, k], self.step_first[i, k], self.step_last[i, k] = r, first, last
                first, last = f, z
            self.step_first[i, len(made)], self.step_last[i, len(made)] = first, last

    def _trie(self, accepted: dict[str, int], chars) -> None:
        code = {c: k + 1 for k, c in enumerate(chars)}
        edges, emits = {}, [-1]
        for p, i in accepted.items():
            node = 0
            for c in p:
                key = node * self.width + code[c]
                if key not in edges:
                    edges[key] = len(emits)
                    emits.append(-1)
                node = edges[key]
            emits[node] = i
        self.edge_key = np.array(sorted(edges), np.int64)
        self.edge_to = np.array([edges[k] for k in self.edge_key.tolist()], np.int64)
        self.emits = np.array(emits, np.int64)

    def passes(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The acceptor of neighbours: does merging the joined text of the two never cross their border?

        Both sides are made by their own merges, lower ranks first.  At each step a merge across the border would go
        first if its rank is below that of the left side's next merge and not above the right side's (of equal ranks
        the leftmost goes first).
        """
        keys, inverse = np.unique(left * self.symbols + right, return_inverse=True)
        a, b = keys // self.symbols, keys % self.symbols
        good = np.ones(len(keys), bool)
        i, j, todo = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.arange(len(keys))
        while len(todo):
            x, y, p, q = a[todo], b[todo], i[todo], j[todo]
            cross = self.step_last[x, p].astype(np.int64) * self.symbols + self.step_first[y, q]
            at = np.searchsorted(self.pair_key, cross)
            hit = np.append(self.pair_key, -1)[at] == cross
            c = np.where(hit, self.pair_rank[at], NONE)
            m, n = self.step_rank[x, p], self.step_rank[y, q]
            crossed = (c < m) & (c <= n) & hit
            good[todo[crossed]] = False
            left_next = m <= n
            i[todo] += left_next
            j[todo] += ~left_next
            todo = todo[~crossed & ~((m == NONE) & (n == NONE))]
        return good[inverse]

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids (int32) on the shortest path of each word; a word is non-empty text with U+2581 for space."""
        sizes = np.array([len(w) for w in words], np.int64)
        cps = np.frombuffer("\0".join(words).encode("utf-32-le", "replace") + b"\0\0\0\0", np.uint32)
        base = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        inner = np.ones(len(cps), bool)
        inner[base + sizes] = False  # the node behind a word's last character
        chars = np.where(inner, self.char_code[cps], 0).astype(np.int64)
        # composition: from every position all pieces that start there
        starts, stops, emitted = [], [], []
        at, node, depth = np.flatnonzero(chars), np.zeros(np.count_nonzero(chars), np.int64), 0
        while len(at):
            key = node * self.width + chars[at + depth]
            k = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
            alive = (self.edge_key[k] == key) & inner[at + depth]
            at, node = at[alive], self.edge_to[k[alive]]
            depth += 1
            out = self.emits[node]
            ok = out >= 0
            starts.append(at[ok])
            stops.append(at[ok] + depth)
            emitted.append(out[ok])
        covered = np.zeros(len(cps), bool)
        covered[starts[0] if starts else []] = True
        alone = np.flatnonzero(inner & ~covered)  # uncovered characters; those of no piece at all have code 0
        starts.append(alone)
        stops.append(alone + 1)
        emitted.append(self.size + chars[alone])
        start, stop, piece = np.concatenate(starts), np.concatenate(stops), np.concatenate(emitted)
        offset = (start - np.repeat(base, sizes + 1)[start]).astype(np.int32)
        order = np.argsort(offset, kind="stable")
        start, stop, piece, offset = start[order], stop[order], piece[order], offset[order]
        # shortest path: nodes of a word in order of their offset
        cost = np.full(len(cps), np.inf)
        cost[base] = 0
        last, back = np.full(len(cps), -1, np.int64), np.full(len(cps), -1, np.int64)
        bounds = np.searchsorted(offset, np.arange((int(offset[-1]) if len(offset) else 0) + 2))
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            s, e, t = start[lo:hi], stop[lo:hi], piece[lo:hi]
            total = cost[s] + self.weight[t]
            if self.bpe and lo:
                # a character of no piece (code 0) merges with nothing
                firm = (last[s] != self.size) & (t != self.size) & (total < cost[e])
                f = np.flatnonzero(firm)
                total[f[~self.passes(last[s[f]], t[f])]] = np.inf
            shorter = total < cost[e]
            s, e, t = s[shorter], e[shorter], t[shorter]
            cost[e], last[e], back[e] = total[shorter], t, s
        # back from the ends; uncovered characters become their bytes
        now, word, steps = base + sizes, np.arange(len(words)), []
        while len(now):
            steps.append((word, now))
            now = back[now]
            going = now > base[word]
            now, word = now[going], word[going]
        w = np.concatenate([x for x, _ in steps])
        nodes = np.concatenate([x for _, x in steps])
        order = np.lexsort((nodes, w))
        w, nodes = w[order], nodes[order]
        ids = last[nodes].astype(np.int32)
        cut = np.searchsorted(w, np.arange(len(words) + 1))
        raw = ids.tobytes()
        out = [raw[4 * a : 4 * b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        for k in np.unique(w[ids >= self.size]).tolist():
            lo, hi = cut[k], cut[k + 1]
            full = []
            for node, t in zip(nodes[lo:hi].tolist(), ids[lo:hi].tolist()):
                if t < self.size:
                    full.append(t)
                elif self.byte_ids:
                    full += [self.byte_ids[x] for x in chr(cps[node - 1]).encode("utf-8", "replace")]
                else:
                    full.append(self.unk)
            out[k] = np.array(full, np.int32).tobytes()
        return out

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return ((" " if self.dummy and text else "") + text).replace(" ", META)

    def words(self, text: str) -> list[str]:
        text = self.normalise(text)
        return self.cutter.findall(text) if self.cutter else [text] if text else []

    def encode_texts(self, texts: list[str | None], cache: dict[str, bytes]) -> list[np.ndarray]:
        cut = [self.words(t or "") for t in texts]
        words = set().union(*cut)
        new = sorted(words.difference(cache), key=len)
        if len(cache) + len(new) > CACHED:
            cache.clear()
            new = sorted(words, key=len)
        i = 0
        while i < len(new):
            j, n = i, 0
            while j < len(new) and (j == i or n + len(new[j]) < BLOCK):
                n += len(new[j]) + 1
                j += 1
            cache.update(zip(new[i:j], self.encode(new[i:j])))
            i = j
        path = cache.__getitem__
        return [np.frombuffer(b"".join(map(path, ws)), np.int32) for ws in cut]

    def decode(self, ids) -> str:
        text = b"".join([self.texts[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy and text.startswith(" ") else text


def compile_model(path: str) -> Machine:
    with open(path, "rb") as f:
        return Machine(f.read())


def encode(docs: DataFrame, machine: Machine, text_col: str = "text", ids_col: str = "ids", same_col: str | None = None) -> DataFrame:
    """The input columns plus ``ids_col``: the array of piece ids of the whole text, empty for a null or empty one.

    Input columns with the name of a result column (in any case) are replaced; repeated rows are encoded alike; an empty
    table gives an empty result.  Long texts are encoded whole, word by word; a word without a place to cut is one lattice, some
    hundred bytes for each of its characters.

    With ``same_col`` the ids are decoded at once, in the same Python worker, and the column says whether that gives
    the text back (it does not where the text itself holds U+2581, the sign for a space).
    """
    kept = others(docs, ids_col, same_col or ids_col)
    src = docs.select(*numbered_columns(docs, kept), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # its size is that of the vocabulary

    def run(batches):
        machine = shared.value  # one object a worker, with the words of all its tasks
        for b in slices(batches, 256):
            texts = b.column("text").to_pylist()
            found = machine.encode_texts(texts, machine.known)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*found, np.zeros(0, np.int32)])))
            columns = [*b.columns[: len(kept)], ids]
            if same_col:
                columns.append(pa.array([machine.decode(x.tolist()) == (t or "") for x, t in zip(found, texts)]))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [*numbered_types(docs, kept), "ids array<int>", *(["same boolean"] if same_col else [])]
    names = [f.split(" ", 1)[0] for f in fields]
    return src.mapInArrow(run, ", ".join(fields)).toDF(*kept, ids_col, *([same_col] if same_col else []))


def decode(df: DataFrame, machine: Machine, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The input columns plus ``out_col``: the text that the ids stand for; null and empty ids give empty text.

    An input column with the name of the result (in any case) is replaced; an empty table gives an empty result.
    """
    kept = others(df, out_col)
    shared = df.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        for b in slices(batches, 256):
            texts = [shared.value.decode(x or ()) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], pa.array(texts, pa.string())], names=[*b.schema.names[: len(kept)], "decoded"])

    src = df.select(*numbered_columns(df, kept), F.col(quoted(ids_col)).alias("ids"))
    return src.mapInArrow(run, ", ".join([*numbered_types(df, kept), "decoded string"])).toDF(*kept, out_col)
