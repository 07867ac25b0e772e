"""BPE encoding and decoding with word ends, by tree concatenation.

``WordBpe`` reads a vocabulary file of the ``tokenizers`` library: NFC, lower case, words by kind of character, bytes as
symbols, the last one of a word with the word end.  Its merges are applied to many words at once: in each round every
word merges all places of its best pair, as arrays.

A word longer than ``LEAF`` symbols (unsplit text: addresses, encoded data, scripts without spaces) is a tree.  Its
halves are encoded in parallel down to the leaves, in the same arrays as all other words.  At each join the symbols of
a window of tokens on both sides are encoded again; where the outermost token on a side is not the one that the half
has there, the window grows to twice the tokens on that side, until both sides agree exactly or end.  A sequence of
tokens is the encoding of its text if and only if every two neighbours are the encoding of theirs, so agreement in one
token on each side makes the whole sequence right.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pillbox.llm.common import slices_of_bytes

LEAF = 64  # symbols of an unsplit text's leaf
WINDOW = 4  # tokens on each side of a join at first
BLOCK = 1 << 18  # symbols merged in one set of arrays
CACHED = 64 << 20  # characters of the words whose ids a Python worker remembers; beyond that it starts anew
REMEMBERED = 256  # longer words are encoded again each time
NONE = np.iinfo(np.int32).max
END = "</w>"
# fixed values: the splitting that the file must ask for, and white space
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
PATTERN = CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def classes(kinds: dict[str, str], top: int) -> dict[str, str]:
    """Character classes (for ``re``) of the code points up to ``top`` whose general category starts with the given letter."""
    out = {name: [] for name in kinds}
    first = {letter: name for name, letter in kinds.items()}
    for c in range(top + 1):
        name = first.get(unicodedata.category(chr(c))[0])
        if name:
            ranges = out[name]
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return {name: "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) for name, ranges in out.items()}


class WordBpe:
    """Arrays of a vocabulary; see the module text.  Its size is fixed by the file."""

    def __init__(self, spec: str):
        self.spec = spec
        read = json.loads(spec)
        model = read["model"]
        plain = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
        steps = [n["type"] for n in (read["normalizer"] or {}).get("normalizers", [])]
        cuts = (read["pre_tokenizer"] or {}).get("pretokenizers", [])
        if model["type"] != "BPE" or any(model.get(k) for k in plain) or model["end_of_word_suffix"] != END:
            raise ValueError("not a plain BPE model with word ends")
        if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"] or cuts[0]["pattern"] != {"Regex": PATTERN}:
            raise ValueError("another normaliser or splitting than the one built here")
        if read["decoder"] or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in read["added_tokens"]):
            raise ValueError("decoders, and added tokens that take in their surroundings, are not supported")
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in read["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for t, i in {**vocab, **self.special}.items():
            self.tokens[i] = t
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + END] for c in letters], np.int32)
        self.size = size
        pairs = [(vocab[a], vocab[b]) for a, b in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in model["merges"]], np.int32)
        born = dict.fromkeys([*self.inner.tolist(), *self.last.tolist()], -1)
        spelled = {i: [i] for i in born}
        for k, ((a, b), i) in enumerate(zip(pairs, self.made.tolist())):
            if i in born or a not in born or b not in born:
                raise ValueError("a token is made twice, or used before it is made")
            born[i] = k
            spelled[i] = spelled[a] + spelled[b]
        keys = np.array([a * size + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pair, self.rank = np.append(keys[order], -1), np.append(order.astype(np.int32), NONE)
        widths = np.array([len(spelled.get(i, ())) for i in range(size)], np.int64)
        self.spell_at = np.concatenate([[0], np.cumsum(widths)])
        self.spell = np.array([s for i in range(size) for s in spelled.get(i, ())], np.int32)
        # the same splitting for texts that stay within ASCII, within 16 bits, and for all others
        self.words_in = []
        for top in (0x7F, 0xFFFF, sys.maxunicode):
            k = classes({"L": "L", "N": "N"}, top)
            self.words_in.append((chr(top), re.compile(rf"{CONTRACTIONS}|[{k['L']}]+|[{k['N']}]|[^{WHITE}{k['L']}{k['N']}]+")))
        self.assigned: set[str] = set()  # characters seen that this Python's Unicode tables know
        self.known: dict[str, bytes] = {}  # ids of words, in a worker
        self.held = 0
        self.library = None

    # texts to words

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised."""
        if not text.isascii():
            new = set(text) - self.assigned
            if any(unicodedata.category(c) == "Cn" for c in new):
                return self._words_by_the_library(text)
            self.assigned |= new
            # letter by letter, as the file asks: a sigma at the end of a word is like any other
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        highest = max(text, default="") if not text.isascii() else ""
        return next(cut for top, cut in self.words_in if highest <= top).findall(text)

    def _words_by_the_library(self, text: str) -> list[str]:
        """For code points that this Python's Unicode tables do not know: what they are follows the library's tables."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.spec)
            self.byte_of = {c: b for b, c in enumerate(byte_letters())}
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, w)).decode() for w, _ in cut]

    # words to tokens

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.searchsorted(self.pair[:-1], key)
        return np.where(self.pair[at] == key, self.rank[at], NONE)

    def _merge_block(self, symbol: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        part = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.full(len(symbol), NONE, np.int32)  # of a symbol and the next one
        inside = np.flatnonzero(part[1:] == part[:-1])
        rank[inside] = self._ranks(symbol[inside], symbol[inside + 1])
        ready = []
        while len(symbol):
            starts = np.flatnonzero(np.diff(part, prepend=-1))
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(part))))
            going = best < NONE
            if not going.all():
                ready.append((part[~going], symbol[~going]))
                part, symbol, rank, best = part[going], symbol[going], rank[going], best[going]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == best)
            # of places that overlap (a symbol merging with itself) every other one, from the left
            head = np.diff(hit, prepend=-2) > 1
            hit = hit[(np.arange(len(hit)) - np.flatnonzero(head)[np.cumsum(head) - 1]) % 2 == 0]
            symbol[hit] = self.made[rank[hit]]
            left = np.ones(len(symbol), bool)
            left[hit + 1] = False
            symbol, part, rank = symbol[left], part[left], rank[left]
            new = hit - np.arange(len(hit))
            changed = np.concatenate([new, new[new > 0] - 1])
            rank[changed] = NONE
            changed = changed[changed + 1 < len(symbol)]
            changed = changed[part[changed] == part[changed + 1]]
            rank[changed] = self._ranks(symbol[changed], symbol[changed + 1])
        part, symbol = (np.concatenate(x) for x in zip(*ready))
        return symbol[np.argsort(part, kind="stable")], np.bincount(part, minlength=len(sizes))

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of each sequence of one or more symbols (their sizes are given), and the numbers of tokens; block by block."""
        ends, out, i = np.cumsum(sizes), [], 0
        while i < len(sizes):
            base = ends[i] - sizes[i]
            j = max(i + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
            out.append(self._merge_block(symbols[base : ends[j - 1]], sizes[i:j]))
            i = j
        return (np.concatenate([x for x, _ in out]), np.concatenate([n for _, n in out])) if out else (symbols, sizes)

    def merge_all(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        if not parts:
            return []
        tokens, counts = self.merge(np.concatenate(parts), np.array([len(p) for p in parts], np.int64))
        return np.split(tokens, np.cumsum(counts)[:-1])

    def spelled(self, tokens: np.ndarray) -> np.ndarray:
        """The symbols that the tokens are made of."""
        at, width = self.spell_at[tokens], self.spell_at[tokens + 1] - self.spell_at[tokens]
        return self.spell[np.arange(width.sum()) - np.repeat(np.cumsum(width) - width - at, width)]

    def join(self, lefts: list[np.ndarray], rights: list[np.ndarray]) -> list[np.ndarray]:
        """The tokens of each left half followed by its right half."""
        out: list = [None] * len(lefts)
        todo = [(k, WINDOW, WINDOW) for k in range(len(lefts))]
        while todo:
            windows = self.merge_all([self.spelled(np.concatenate([lefts[k][-m:], rights[k][:n]])) for k, m, n in todo])
            again = []
            for (k, m, n), w in zip(todo, windows):
                left, right = lefts[k], rights[k]
                left_agrees = m >= len(left) or w[0] == left[-m]
                right_agrees = n >= len(right) or w[-1] == right[n - 1]
                if left_agrees and right_agrees:
                    out[k] = np.concatenate([left[: max(0, len(left) - m)], w, right[n:]])
                else:
                    again.append((k, m if left_agrees else 2 * m, n if right_agrees else 2 * n))
            todo = again
        return out

    def encode_unsplit(self, words: list[np.ndarray]) -> list[np.ndarray]:
        """The tokens of long words of symbols, by trees of halves."""
        trees = [np.array_split(w, 1 << ((len(w) - 1) // LEAF).bit_length()) for w in words]
        leaves = iter(self.merge_all([p for t in trees for p in t]))
        trees = [[next(leaves) for _ in t] for t in trees]
        while any(len(t) > 1 for t in trees):
            joined = iter(self.join([p for t in trees if len(t) > 1 for p in t[::2]], [p for t in trees if len(t) > 1 for p in t[1::2]]))
            trees = [[next(joined) for _ in t[::2]] if len(t) > 1 else t for t in trees]
        return [t[0] for t in trees]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids (little-endian, 32 bits) of each word; a word is non-empty and normalised."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        short = sizes <= LEAF
        tokens, counts = self.merge(symbols[np.repeat(short, sizes)], sizes[short])
        ids, cuts = tokens.astype("<u4").tobytes(), (4 * np.concatenate([[0], np.cumsum(counts)])).tolist()
        found = iter([ids[a:b] for a, b in zip(cuts, cuts[1:])])
        long = iter(self.encode_unsplit([symbols[ends[k] - sizes[k] : ends[k]] for k in np.flatnonzero(~short)]))
        return [next(found) if s else next(long).astype("<u4").tobytes() for s in short.tolist()]

    def encode_texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids (uint32) of each text; special tokens in a text are themselves."""
        cut, special = [], {}
        for t in texts:
            t = t or ""
            if self.special_cut and self.special_cut.search(t):
                ws = []
                for k, piece in enumerate(self.special_cut.split(t)):
                    if k % 2:
                        special[f" {piece}"] = np.uint32(self.special[piece]).tobytes()  # no word has a space
                        ws.append(f" {piece}")
                    else:
                        ws += self.words(piece)
            else:
                ws = self.words(t)
            cut.append(ws)
        new = sorted(set().union(*cut).difference(self.known, special), key=len)
        kept = [w for w in new if len(w) <= REMEMBERED]
        self.held += sum(map(len, kept))
        if self.held > CACHED:
            self.known.clear()
            new = sorted(set().union(*cut).difference(special), key=len)
            kept = [w for w in new if len(w) <= REMEMBERED]
            self.held = sum(map(len, kept))
        found = dict(zip(new, self.encode_words(new)))
        self.known.update((w, found.pop(w)) for w in kept)
        found |= special
        if found:
            ids = lambda w: self.known.get(w) or found[w]
        else:
            ids = self.known.__getitem__
        return [np.frombuffer(b"".join(map(ids, ws)), "<u4") for ws in cut]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens of the ids with a space between; the vocabulary has no decoder of its own."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def compile_vocabulary(path: str) -> WordBpe:
    with open(path, encoding="utf-8") as f:
        return WordBpe(f.read())


def bpe_encode(docs: DataFrame, bpe: WordBpe, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, digests: bool = False, decoded: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens and what is asked for: ids (array), decoded (text), ids_sha256 and decoded_sha256.

    ids_sha256 is of the ids as little-endian unsigned 32-bit integers, decoded_sha256 of the decoded text in UTF-8.
    A null or empty text, or one of white space only, has no ids and decodes to empty text.  Texts are encoded whole; a
    task holds a slice of about a megabyte or one longer text, and some hundred bytes for each byte of one unsplit word.
    Repeated rows and ids, null ids included, each give their own row.  Only the two named columns are read, so others
    may have any name.  An empty table gives an empty result.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(bpe)  # its size is that of the vocabulary
    fields = {"n_tokens": "bigint"}
    if ids:
        fields["ids"] = "array<bigint>"
    if decoded:
        fields["decoded"] = "string"
    if digests:
        fields |= {"ids_sha256": "string", "decoded_sha256": "string"}

    def run(batches):
        bpe = shared.value  # one object a worker, with the words of all its tasks
        for b in slices_of_bytes(batches, "text"):
            found = bpe.encode_texts(b.column("text").to_pylist())
            texts = [bpe.decode(x) for x in found] if decoded or digests else []
            columns = {"n_tokens": pa.array([len(x) for x in found], pa.int64())}
            if ids:
                ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype(np.int64)))
            if decoded:
                columns["decoded"] = pa.array(texts, pa.string())
            if digests:
                columns["ids_sha256"] = pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in found], pa.string())
                columns["decoded_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("id"), *columns.values()], names=["id", *columns])

    out = src.mapInArrow(run, ", ".join([f"id {src.schema['id'].dataType.simpleString()}", *(f"{k} {v}" for k, v in fields.items())]))
    return out.withColumnRenamed("id", id_col)


def bpe_decode(encoded: DataFrame, bpe: WordBpe, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: id, decoded (the text that the ids stand for; empty for null or no ids)."""
    src = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    shared = encoded.sparkSession.sparkContext.broadcast(bpe)

    def run(batches):
        for b in batches:
            texts = [shared.value.decode(np.array(x or (), np.int64)) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string())], names=["id", "decoded"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, decoded string").withColumnRenamed("id", id_col)
