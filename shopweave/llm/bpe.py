"""BPE encoding and decoding by prefix-sharing traversal of a trie of distinct words.

A text's BPE encoding is the one segmentation in which every token is what BPE makes of its own
symbols and no seam between neighbours is merged across. Both tests are local, so the encoding of a
prefix is known by its last token alone: the longest path in a trie of words needs one state a node.
Distinct words of a batch, in sorted order, are the trie's leaves in depth-first order; the states
up to the prefix shared with the word before stay on the stack and are never computed again. A state
is computed when a longer prefix first asks for it.

Spark deals out the rows; a task keeps a bounded cache of words, so no shuffle is needed. Nulls are empty texts and have no tokens. Very long texts are encoded whole.
"""

from __future__ import annotations

import gc
import json
import unicodedata
from codecs import charmap_decode
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import slices

#: Cached words of a task, words of uncommon chunks, seams of tokens, and endings of words; beyond that a cache
#: starts anew. They bound memory only.
CACHED = 400_000
OTHERS = 100_000
SEAMS = 200_000
ENDINGS = 50_000
#: Bytes of text whose chunks are held at once.
STEP = 4_000_000

# The pre-tokenizer's pattern, the end-of-word mark, marks that can follow a word, and
# what is no white space to the tokenizer.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
END = "</w>"
MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
CHUNKS = regex.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: What most chunks are: letters whose lower case is another or the same single letter, and perhaps marks after them.
#: Arrow splits those.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
COMMON = rf"\A[{LETTERS}]+[{''.join(chr(92) + x for x in MARKS)}]*\z"
LOWER = "".join(c for c in map(chr, range(0x61, 0x100)) if c.isalpha() and c not in "\u00aa\u00b5\u00ba" and c == c.lower())
#: Letters by which the tokens that can end at a place are looked up.
NEAR = 4
#: Up to here Python and the library agree on letters and cases; chunks with characters beyond are
#: normalized and split by the library, whose Unicode tables are of another version.
KNOWN = "\u052f"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if it prints, else the next free one."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, free = [""] * 256, 256
    for byte in range(256):
        if byte in prints:
            letters[byte] = chr(byte)
        else:
            letters[byte], free = chr(free), free + 1
    return letters


class Ends:
    """The tokens that a stretch of letters can end with."""

    def __init__(self):
        self.ids: dict[str, int] = {}
        self.long: dict[str, set[int]] = {}
        self.known: dict[str, tuple[list[int], list[tuple[int, int]]]] = {}

    def add(self, text: str, token: int) -> None:
        self.ids[text] = token
        if len(text) > NEAR:
            self.long.setdefault(text[-NEAR:], set()).add(len(text))

    def near(self, near: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Of tokens that can end with these letters: lengths of longer ones, and (length, token) of
        the others, the longest first."""
        if len(self.known) >= ENDINGS:
            self.known.clear()
        short = [(n, self.ids[near[-n:]]) for n in range(len(near), 0, -1) if near[-n:] in self.ids]
        known = self.known[near] = (sorted(self.long.get(near, ()), reverse=True), short)
        return known


class Vocabulary:
    """Tokens, merges and seams of a tokenizer file, and the encoder over them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        ids = stored["model"]["vocab"]
        self.tokenizer = Tokenizer.from_file(path)
        self.special = {x["content"]: x["id"] for x in stored["added_tokens"]}
        self.tokens = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.by_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.rank, self.parts = {}, {}
        for rank, (left, right) in enumerate(stored["model"]["merges"]):
            pair = (ids[left], ids[right])
            self.rank[pair] = rank
            self.parts.setdefault(ids[left + right], (rank, *pair))
        self.letters = "".join(byte_letters())
        self.seams: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.inner, self.last = Ends(), Ends()
        for token, i in ids.items():
            if self.is_whole(i):
                final = token.endswith(END) and token != END
                (self.last if final else self.inner).add(token.removesuffix(END), i)
        self.split: dict[str, list[str]] = {}
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {x: n for n, x in enumerate(self.special)}
        self.flat = np.array([*self.special.values()], np.int32)
        self.sizes = np.ones(len(self.special), np.int64)
        self.starts = np.arange(len(self.special))

    def spine(self, token: int, side: int) -> list[tuple[int, int | float]]:
        """The token and its outermost parts on a side, the smallest first, each with the rank of
        the merge that consumes it."""
        found: list[tuple[int, int | float]] = [(token, float("inf"))]
        while made := self.parts.get(token):
            token = made[side]
            found.append((token, made[0]))
        return found[::-1]

    def seam(self, left: int, right: int, until: float = float("inf")) -> bool:
        """Whether BPE leaves the seam of two tokens alone, for merges of a rank below ``until``.

        Merges run in order of rank, of equal ranks the leftmost first. The parts that meet at the
        seam grow in that order; the seam is lost if a pair merges before either part is consumed.
        """
        lefts, rights = self.spine(left, 2), self.spine(right, 1)
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = lefts[i], rights[j]
            rank = self.rank.get((a, b), float("inf"))
            if rank < min(a_ends, until) and rank <= b_ends:
                return False
            if a_ends == b_ends == float("inf"):
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1

    def is_whole(self, token: int) -> bool:
        """Whether BPE makes this token of its own symbols."""
        if token not in self.whole:
            made = self.parts.get(token)
            self.whole[token] = made is None or (
                self.is_whole(made[1]) and self.is_whole(made[2]) and self.seam(made[1], made[2], made[0])
            )
        return self.whole[token]

    def encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """Token ids of each word; sorted and distinct words share the work on their prefixes."""
        out, before = [], ""
        inner, last = self.inner, self.last
        seams, seam = self.seams, self.seam
        # of each prefix the last token and where it begins; None: not asked for yet
        tokens: list[int | None] = [-1]
        begins: list[int] = [0]
        for word in words:
            size = len(word)
            most = min(len(before), size) - 1  # the end of a word is no prefix of another
            shared = 0
            while shared < most and word[shared] == before[shared]:
                shared += 1
            tokens[shared + 1 :] = [None] * (size - shared)
            begins[shared + 1 :] = [0] * (size - shared)
            asked = [size]
            while asked:
                end = asked[-1]
                ends = last if end == size else inner
                near = word[end - NEAR if end > NEAR else 0 : end]
                long, short = ends.known.get(near) or ends.near(near)
                ids = ends.ids
                before_it = -1
                for length in long:
                    if length <= end and (token := ids.get(word[end - length : end])) is not None:
                        begin = end - length
                        if not begin:
                            break
                        if (before_it := tokens[begin]) is None:
                            break
                        if (kept := seams.get((before_it, token))) is None:
                            kept = seams[before_it, token] = seam(before_it, token)
                        if kept:
                            break
                else:
                    for length, token in short:
                        begin = end - length
                        if not begin:
                            break
                        if (before_it := tokens[begin]) is None:
                            break
                        if (kept := seams.get((before_it, token))) is None:
                            kept = seams[before_it, token] = seam(before_it, token)
                        if kept:
                            break
                    else:
                        raise ValueError(f"no token ends {word[:end]!r}")
                if before_it is None:
                    asked.append(begin)
                    continue
                tokens[end], begins[end] = token, begin
                asked.pop()
            ids_of, at = [], size
            while at:
                ids_of.append(tokens[at])
                at = begins[at]
            out.append(tuple(ids_of[::-1]))
            before = word
        return out

    def words_of(self, chunk: str) -> list[str]:
        """The words of a chunk, as letters for bytes, after normalization; special tokens are words of
        their own."""
        if chunk and chunk.isascii() and chunk.isprintable() and "<|" not in chunk:
            return self.plain_words(chunk)
        words = []
        for part in self.by_special.split(chunk):
            if part in self.special:
                words.append(part)
            else:
                for piece in CHUNKS.findall(part):
                    words += self.plain_words(piece)
        return words

    def plain_words(self, chunk: str) -> list[str]:
        if max(chunk) > KNOWN:
            plain = self.tokenizer.normalizer.normalize_str(chunk)
            return [x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)]
        # a sigma that ends a word isn't treated specially
        lower = chunk.lower() if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        letters = lower.rstrip(MARKS)
        if letters.isalpha():  # what most chunks are: letters, and perhaps marks after them
            words = [letters, lower[len(letters) :]] if len(letters) < len(lower) else [lower]
        else:
            words = WORDS.findall(lower)
        return words if lower.isprintable() and lower.isascii() else list(map(self.as_bytes, words))

    def as_bytes(self, word: str) -> str:
        return charmap_decode(word.encode(), "strict", self.letters)[0]

    def learn(self, words: list[str]) -> None:
        """Encode the words not seen before, by the trie."""
        if len(self.words) > CACHED:
            self.clear()
        if len(self.seams) > SEAMS:
            self.seams.clear()
        new = sorted(set(words).difference(self.words))
        ids = self.encode_words(new)
        first = len(self.words)
        self.words.update(zip(new, range(first, first + len(new)), strict=True))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
        self.sizes = np.concatenate([self.sizes, sizes])
        self.starts = np.concatenate([self.starts, starts])
        self.flat = np.concatenate([self.flat, flat])

    def split_others(self, chunks: list[str]) -> list[list[str]]:
        """The words of chunks that aren't common ones."""
        if len(self.split) > OTHERS:
            self.split.clear()
        for chunk in chunks:
            if chunk not in self.split:
                self.split[chunk] = self.words_of(chunk)
        return list(map(self.split.__getitem__, chunks))

    def chunk_ids(self, chunks: pa.StringArray) -> pa.ListArray:
        """The ids of each chunk. Common chunks are split into letters and marks by Arrow, and Python sees
        their distinct words; it splits the others itself."""
        common = pc.and_not(pc.match_substring_regex(chunks, COMMON), pc.match_substring(chunks, "<|"))
        lower = pc.utf8_lower(chunks.filter(common))
        letters = pc.ascii_rtrim(lower, characters=MARKS)
        marked = pc.not_equal(pc.binary_length(letters), pc.binary_length(lower))
        marks = pc.utf8_ltrim(lower.filter(marked), characters=LOWER)
        parts = pa.concat_arrays([letters, marks]).dictionary_encode()
        names = [x if x.isascii() else self.as_bytes(x) for x in parts.dictionary.to_pylist()]
        others = self.split_others(chunks.filter(pc.invert(common)).to_pylist())
        other_words = list(chain.from_iterable(others))
        self.learn(names + other_words)

        # the number of words of each chunk, then all words in the order of chunks
        is_common, has_marks = common.to_numpy(zero_copy_only=False), marked.to_numpy(zero_copy_only=False)
        counts = np.empty(len(chunks), np.int64)
        counts[is_common] = 1 + has_marks
        other_counts = np.fromiter(map(len, others), np.int64, len(others))
        counts[~is_common] = other_counts
        edges = np.concatenate([[0], np.cumsum(counts)])
        first = edges[:-1]
        own = np.fromiter(map(self.words.__getitem__, names), np.int64, len(names))[parts.indices.to_numpy()]
        words = np.empty(edges[-1], np.int64)
        words[first[is_common]] = own[: len(letters)]
        words[first[is_common][has_marks] + 1] = own[len(letters) :]
        within = np.arange(len(other_words)) - np.repeat(np.cumsum(other_counts) - other_counts, other_counts)
        at = np.repeat(first[~is_common], other_counts) + within
        words[at] = np.fromiter(map(self.words.__getitem__, other_words), np.int64, len(other_words))

        sizes = self.sizes[words]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.starts[words] - ends[:-1], sizes) + np.arange(ends[-1])]
        return pa.ListArray.from_arrays(pa.array(ends[edges].astype(np.int32)), pa.array(ids))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, one after another, and the number of ids of each text; a null is empty.

        Arrow splits the texts at ASCII white space and finds the distinct chunks.
        """
        parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        chunks = parts.flatten().dictionary_encode()
        found = self.chunk_ids(chunks.dictionary).take(chunks.indices)
        ends = np.concatenate([[0], np.cumsum(found.value_lengths().to_numpy(), dtype=np.int64)])
        counts = parts.value_lengths().to_numpy()
        edge = ends[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        return found.flatten().to_numpy(), np.diff(edge)

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by spaces, as this kind of tokenizer has no decoder; specials stay."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encoded(path: str, texts: pa.Array):
    """Ids and counts of a batch's rows, in steps of bounded size: (first row, ids, counts)."""
    known = vocabulary(path)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    gc.disable()  # a great many tuples are made here, and no cycles
    try:
        for start, end in slices(sizes, STEP):
            yield start, *known.encode(texts.slice(start, end - start))
    finally:
        gc.enable()


def arrays(steps: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """Steps of (ids, counts) as one array of ids for each row."""
    counts = np.concatenate([np.zeros(1, np.int32), *(x[1] for x in steps)])
    flat = np.concatenate([np.zeros(0, np.int32), *(x[0] for x in steps)])
    return pa.ListArray.from_arrays(pa.array(np.cumsum(counts, dtype=np.int32)), pa.array(flat))


def encode(path: str, text: str = "text") -> Column:
    """Token ids of each whole text, special tokens not added, as an array of ints; never null."""

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        return arrays([(ids.astype(np.int32), counts) for _, ids, counts in encoded(path, texts)])

    return ids_of.asNondeterministic()(F.col(text))


def round_trip(path: str, text: str = "text") -> Column:
    """Struct of a text's ids and of what they decode to; one pass through Python for both."""

    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def both_of(texts: pa.Array) -> pa.Array:
        steps, decoded = [], []
        for _, ids, counts in encoded(path, texts):
            steps.append((ids.astype(np.int32), counts))
            decoded += map(vocabulary(path).decode, np.split(ids, np.cumsum(counts)[:-1]))
        return pa.StructArray.from_arrays([arrays(steps), pa.array(decoded, pa.string())], ["ids", "decoded"])

    return both_of.asNondeterministic()(F.col(text))


def decode(path: str, ids: str = "ids") -> Column:
    """The tokens of each array of ids joined by spaces; a null or empty array gives an empty text."""

    @F.arrow_udf("string")
    def text_of(arrays: pa.Array) -> pa.Array:
        known = vocabulary(path)
        flat = arrays.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(np.fromiter((x or 0 for x in arrays.value_lengths().to_pylist()), np.int64))
        return pa.array(map(known.decode, np.split(flat, ends[:-1]) if len(ends) else []), pa.string())

    return text_of.asNondeterministic()(F.col(ids))

