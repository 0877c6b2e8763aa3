"""BPE encoding by backtracking, and decoding, for a vocabulary with an end-of-word suffix.

A word is a sequence of symbols: its bytes, the last one marked as the end. An Aho-Corasick
automaton over all tokens gives the longest token at each place. Going left to right, a
token is taken if it is compatible with the one before: the merges would leave the two
side by side. If not, the next shorter token that is its prefix is tried; if none is left,
the token before is taken back and the place is marked as a dead end. Each place fails at
most once, so the work is linear in the word, and the result is that of the merges.
Compatibility of a pair is found by undoing merges around the seam, and kept in a table.

Decoding looks up each id's piece in one buffer by a table of offsets.

Cases: null is the empty text, with no ids. Special tokens inside a text are taken as such
tokens, as the library does by default. Texts of any length are encoded whole. Repeated
rows are each encoded; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallymill.llm.common import per_task, text_slices, texts

#: Characters on which Python's lower case, white space and normal forms agree with the library's.
PLAIN = re.compile(r"[\t\n\r -~¡-¬®-ȳ]*")
#: Bytes that a task spends on encodings of pieces it has met, the longest piece remembered, and pairs remembered.
REMEMBERED_BYTES, REMEMBERED_LENGTH, REMEMBERED_PAIRS = 64 << 20, 40, 200_000
#: Bytes of an entry besides its piece and ids.
_ENTRY = 200


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself, or for the others a character from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


class Merges:
    """The merge table of a vocabulary, over symbols 0 to 511 (a byte; a byte that ends its word)."""

    def __init__(self, model: dict):
        import ahocorasick

        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        alphabet = byte_alphabet()
        names = alphabet + [c + suffix for c in alphabet]
        index = {name: i for i, name in enumerate(names)}
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(len(names))]
        self.merged: dict[tuple[int, int], int] = {}
        self.symbols = [chr(i) for i in range(len(names))]
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = index[left], index[right]
            index[left + right] = self.merged[pair] = len(self.parts)
            self.parts.append(pair)
            self.symbols.append(self.symbols[pair[0]] + self.symbols[pair[1]])
        self.ids = [b""] * len(self.parts)
        for name, i in index.items():
            self.ids[i] = vocab[name].to_bytes(4, "little")
        self.length = [len(s) for s in self.symbols]
        place = {s: i for i, s in enumerate(self.symbols)}
        self.shorter = [self._prefix(s, place) for s in self.symbols]
        self.automaton = ahocorasick.Automaton()
        for i, s in enumerate(self.symbols):
            self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}

    @staticmethod
    def _prefix(symbols: str, place: dict[str, int]) -> int:
        """The longest token that is a proper prefix, or -1."""
        return next((place[symbols[:n]] for n in range(len(symbols) - 1, 0, -1) if symbols[:n] in place), -1)

    def compatible(self, pair: tuple[int, int]) -> bool:
        known = self.pairs.get(pair)
        if known is None:
            known = self._stays(*pair)
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            self.pairs[pair] = known
        return known

    def _stays(self, left: int, right: int) -> bool:
        """Would merging both sides from symbols leave the seam between them alone?

        The later of the two tokens is taken apart again and again, which goes back in
        time through the merges. The seam is crossed if at some moment the two tokens
        that touch it merge before the step that was undone last would have happened;
        of equal merges the one further left happens first.
        """
        parts, merged = self.parts, self.merged
        bound = len(parts) + 1
        while True:
            if merged.get((left, right), bound) < bound:
                return False
            if left > right:
                bound, (_, inner) = left, parts[left]
                if inner != left:
                    left = inner
                    continue
                bound, (inner, _) = right + 1, parts[right]
                if inner == right:
                    return True
                right = inner
            else:
                bound, (inner, _) = right + 1, parts[right]
                if inner != right:
                    right = inner
                    continue
                bound, (_, inner) = left, parts[left]
                if inner == left:
                    return True
                left = inner

    def encode(self, word: bytes) -> list[int]:
        """The tokens (not yet ids) of one word."""
        symbols = word[:-1].decode("latin-1") + chr(256 + word[-1])
        longest = [-1] * (len(symbols) + 1)
        length = self.length
        for last, token in self.automaton.iter(symbols):
            longest[last + 1 - length[token]] = token  # ends ascend, so the longest is the last
        alive = bytearray(b"\1") * (len(symbols) + 1)
        taken: list[int] = []
        at, token = 0, longest[0]
        while at < len(symbols):
            while token >= 0:
                if alive[at + length[token]] and (not taken or self.compatible((taken[-1], token))):
                    break
                token = self.shorter[token]
            if token >= 0:
                taken.append(token)
                at += length[token]
                token = longest[at]
            else:
                alive[at] = 0
                token = taken.pop()
                at -= length[token]
        return taken


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, vocabulary: str):
        import regex
        from tokenizers import Tokenizer

        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        self.merges = Merges(spec["model"])
        self.library = Tokenizer.from_file(vocabulary)  # its normalizer and split, for unusual characters
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        self.word = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.known: dict[str, bytes] = {}
        self.size = 0  # of what is known, in bytes
        names = {i: name for name, i in spec["model"]["vocab"].items()} | {i: name for name, i in self.specials.items()}
        pieces = [names.get(i, "").encode() + b" " for i in range(max(names) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        self.buffer = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.of_byte = {c: b for b, c in enumerate(byte_alphabet())}

    def forget(self) -> None:
        """Drop what was remembered of the texts met so far."""
        self.known.clear()
        self.merges.pairs.clear()
        self.size = 0

    def _word(self, word: bytes) -> bytes:
        ids = self.merges.ids
        return b"".join([ids[t] for t in self.merges.encode(word)])

    def _piece(self, piece: str) -> bytes:
        """A space-delimited piece: one or more words, each of which may have been met before."""
        known = self.known
        words = self.word.findall(piece)
        if words != [piece]:
            found = b"".join([known[w] if w in known else self._piece(w) for w in words])
        else:
            found = self._word(piece.encode())
        if len(piece) <= REMEMBERED_LENGTH:
            self.size += _ENTRY + len(piece) + len(found)
            if self.size > REMEMBERED_BYTES:
                known.clear()
                self.size = 0
            known[piece] = found
        return found

    def _segment(self, text: str) -> bytes:
        if PLAIN.fullmatch(text):
            known, piece = self.known, self._piece
            return b"".join([known[p] if p in known else piece(p) for p in text.lower().split()])
        normal = self.library.normalizer.normalize_str(text)
        split = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return b"".join([self._word(bytes(map(self.of_byte.__getitem__, w))) for w, _ in split if w])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if "<|" not in text or not self.special.search(text):
            return self._segment(text)
        parts, at = [], 0
        for m in self.special.finditer(text):
            parts += [self._segment(text[at : m.start()]), np.array([self.specials[m[0]]], dtype="<u4").tobytes()]
            at = m.end()
        return b"".join([*parts, self._segment(text[at:])])

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the tokens, joined by one space."""
        wanted = np.frombuffer(ids, dtype="<u4")
        if not len(wanted):
            return b""
        begin = self.offsets[wanted]
        size = self.offsets[wanted + 1] - begin
        ends = np.cumsum(size)
        places = np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)
        return self.buffer[places].tobytes()[:-1]


@cache
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


#: Ids decoded at once, so that a very long text needs little memory besides itself.
DECODED_AT_ONCE = 1 << 20


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids and decoded text of every row of ``docs`` (doc_id, text). No shuffle."""

    def begin() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        own = codec(vocabulary)

        def coded(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [own.encode(t) for t in texts(batch)]
            lists = [np.frombuffer(x, dtype="<u4").astype(np.int64) for x in ids]
            decoded = [own.decode(x).decode() for x in ids]
            columns = [batch.column("doc_id"), pa.array(lists, pa.list_(pa.int64())), pa.array(decoded, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

        return coded

    schema = "doc_id long, ids array<long>, decoded string"
    return per_task(docs.select("doc_id", "text"), begin, schema, lambda: codec(vocabulary).forget())


def encode_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of ids and decoded text, for every row of ``docs``. No shuffle."""

    def begin() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        own = codec(vocabulary)

        def coded(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, ids_sums, text_sums = [], [], []
            for text in (t for part in text_slices(batch) for t in part):
                ids = own.encode(text)
                counts.append(len(ids) // 4)
                ids_sums.append(hashlib.sha256(ids).hexdigest())
                decoded = hashlib.sha256()
                for at in range(0, len(ids), 4 * DECODED_AT_ONCE):
                    decoded.update(b" " * bool(at) + own.decode(ids[at : at + 4 * DECODED_AT_ONCE]))
                text_sums.append(decoded.hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sums), pa.array(text_sums)]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return coded

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return per_task(docs.select("doc_id", "text"), begin, schema, lambda: codec(vocabulary).forget())
