"""Token ids of whole texts with a public tokenizer file.

``TextEncoder`` returns what ``Tokenizer.encode(text, add_special_tokens=False)``
returns.  For files whose rules never look across white space (lower-casing
word BPE) every distinct word is encoded once per worker and then looked up in
a bounded cache; other files get the whole text."""

from __future__ import annotations

import itertools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from colloquy.llm.common import map_arrow

WORD_BPE = "word_bpe_49k.json"
CACHE_WORDS = 1_000_000
LONG_WORD = 64
CHUNK_BYTES = 8_000_000       # texts whose words are looked up together, one text at least
RUN_PIECES = 64               # new pieces that the library gets as one string

# Characters on which NFC and per-character lower-casing are plain: ASCII
# letters and marks (without "<", which may begin an added token), Latin
# letters up to U+024F without U+0130.
_PLAIN = regex.compile("[!-;=-~À-ÖØ-öø-įı-ɏ]+")
_PLAIN_RE2 = "^[!-;=-~À-ÖØ-öø-įı-ɏ]*$"
_MARK_CHARS = "!\"#$%&'()*+,-./:;=>?@[]^_`{|}~"
_MARKS = frozenset(_MARK_CHARS.encode())


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other
    bytes for the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


def _runs(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places ``at[k]``, ``at[k] + 1``, ... (``n[k]`` of them) for every k."""
    ends = np.cumsum(n)
    return np.repeat(at - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


class TextEncoder(dict):
    """word (UTF-8 bytes) -> packed ids; misses are encoded by the library."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # the tasks are what runs side by side
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bare = Tokenizer(self.model)                    # the model alone, for pieces joined by spaces
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.token_chars = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, k in self.tokenizer.get_vocab().items():
            self.token_chars[k] = len(token.removesuffix(getattr(self.model, "end_of_word_suffix", None) or ""))
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4")
        norm = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.by_word = (norm == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in pre] == ["Split", "ByteLevel"]
                        and pre[0]["invert"] and pre[0]["behavior"] == "Removed" and not pre[1]["add_prefix_space"]
                        and spec["post_processor"] is None)
        self.split = regex.compile(pre[0]["pattern"]["Regex"]) if self.by_word else None
        self.by_word = self.by_word and all(x["content"].startswith("<") for x in spec["added_tokens"])
        self.letters = _byte_letters()
        self.spelling = dict(enumerate(self.letters[128:], 128))
        self.pieces: dict[str, bytes] = {}

    def _pack(self, ids) -> bytes:
        return np.asarray(ids, dtype=self.dtype).tobytes()

    def _library(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, word: bytes) -> bytes:
        if len(word) > LONG_WORD:
            return self._library(word.decode("utf-8"))
        if word.isalpha():                                   # ASCII letters: one piece
            out = self._piece(word.lower().decode())
        elif word[-1] in _MARKS and word[:-1].isalpha():     # ... and one mark
            out = self._piece(word[:-1].lower().decode()) + self._piece(chr(word[-1]))
        else:
            text = word.decode("utf-8")
            if _PLAIN.fullmatch(text):
                out = b"".join(map(self._piece, self.split.findall(text.lower())))
            else:
                out = self._library(text)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = out
        return out

    def _piece(self, piece: str) -> bytes:
        out = self.pieces.get(piece)
        if out is None:
            if len(self.pieces) >= CACHE_WORDS:
                self.pieces.clear()
            out = self.pieces[piece] = self._model(piece)
        return out

    def _spell(self, piece: str) -> str:
        """A piece of a plain word in the byte-level alphabet (ASCII stands for itself)."""
        return piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))

    def _spell_all(self, pieces: list[str]) -> list[str]:
        joined = " ".join(pieces)
        return pieces if joined.isascii() else joined.encode().decode("latin-1").translate(self.spelling).split(" ")

    def _model(self, piece: str) -> bytes:
        return self._pack([t.id for t in self.model.tokenize(self._spell(piece))])

    def _learn_pieces(self, new: list[str]) -> list[bytes]:
        """Packed ids of distinct pieces that are not in the cache, learned
        together: the library's model gets them in white-space-joined runs, and
        the lengths of the tokens tell where each piece's ids end."""
        if len(self.pieces) + len(new) > CACHE_WORDS:
            self.pieces.clear()
        spelled = self._spell_all(new)
        runs = [" ".join(spelled[a:a + RUN_PIECES]) for a in range(0, len(spelled), RUN_PIECES)]
        ids = list(itertools.chain.from_iterable(
            e.ids for e in self.bare.encode_batch_fast(runs, add_special_tokens=False)))
        ids = np.array(ids, self.dtype)
        spelt = np.concatenate(([0], np.cumsum(self.token_chars[ids])))
        wanted = np.cumsum(np.fromiter(map(len, spelled), np.int64, len(spelled)))
        ends = np.searchsorted(spelt, wanted)
        if spelt[-1] != wanted[-1] or (spelt[ends] != wanted).any():
            packed = list(map(self._model, new))             # tokens that do not spell their piece
        else:
            raw, ends = ids.tobytes(), (ends * self.dtype.itemsize).tolist()
            packed = [raw[a:b] for a, b in zip([0, *ends], ends)]
        self.pieces.update(zip(new[:CACHE_WORDS], packed))
        return packed

    def _packed_pieces(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of distinct pieces of plain words."""
        found = list(map(self.pieces.get, pieces))
        new = [p for p, packed in zip(pieces, found) if packed is None]
        if new:
            learned = iter(self._learn_pieces(new))
            found = [next(learned) if packed is None else packed for packed in found]
        return found

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words one after another, and how many each has.
        Plain words are cut into pieces: letters are one, letters and a mark
        two, the rest is split by the pattern; each distinct piece is looked up
        once.  Other words are looked up themselves."""
        plain = pc.and_(pc.match_substring_regex(words, _PLAIN_RE2), pc.less_equal(pc.binary_length(words), LONG_WORD))
        lower = pc.utf8_lower(words)
        head = pc.utf8_rtrim(lower, characters=_MARK_CHARS)
        cut = pc.subtract(pc.binary_length(lower), pc.binary_length(head))
        short = pc.or_(pc.utf8_is_alpha(head), pc.equal(pc.binary_length(lower), 0))
        simple = pc.and_(pc.and_(plain, short), pc.less_equal(cut, 1))
        tail = pc.if_else(pc.equal(cut, 1), pc.utf8_slice_codeunits(lower, -1), "")
        plain, simple = (m.to_numpy(zero_copy_only=False) for m in (plain, simple))
        rest, other = np.flatnonzero(plain & ~simple), np.flatnonzero(~plain)
        simple = np.flatnonzero(simple)
        split = [self.split.findall(w) or [""] for w in lower.take(pa.array(rest)).to_pylist()]
        pieces = pa.concat_arrays([head.take(pa.array(simple)), tail.take(pa.array(simple)).cast(head.type),
                                   pa.array(list(itertools.chain.from_iterable(split)), head.type)]).dictionary_encode()
        packed = self._packed_pieces(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        index, known = pieces.indices.to_numpy(), len(packed)
        packed += [self[w] for w in words.take(pa.array(other)).cast(pa.binary()).to_pylist()]

        count = np.ones(len(words), np.int64)                # pieces of a word
        count[simple] = 2
        count[rest] = np.fromiter(map(len, split), np.int64, len(split))
        at = np.cumsum(count) - count
        piece = np.empty(int(count.sum()), np.int64)
        piece[at[simple]], piece[at[simple] + 1] = index[:len(simple)], index[len(simple):2 * len(simple)]
        piece[_runs(at[rest], count[rest])] = index[2 * len(simple):]
        piece[at[other]] = known + np.arange(len(other))
        table = np.frombuffer(b"".join(packed), self.dtype)
        length = np.fromiter(map(len, packed), np.int64, len(packed)) // self.dtype.itemsize
        n = length[piece]
        before = np.concatenate(([0], np.cumsum(n)))
        return table[_runs((np.cumsum(length) - length)[piece], n)], before[at + count] - before[at]

    def _chunk(self, texts: pa.Array) -> Iterator[np.ndarray]:
        words = pc.ascii_split_whitespace(texts)             # may hold empty words, which have no ids
        coded = words.flatten().dictionary_encode()
        table, length = self._words(coded.dictionary)
        word = coded.indices.to_numpy()
        n = length[word]
        ids = table[_runs((np.cumsum(length) - length)[word], n)]
        last = np.cumsum(pc.list_value_length(words).fill_null(0).to_numpy())
        bounds = np.concatenate(([0], np.cumsum(n)))[last].tolist()
        return (ids[a:b] for a, b in zip([0, *bounds], bounds))

    def encode_column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of every text of a string column (null: none), as ``encode`` gives
        them: the words of a chunk and their pieces are told apart by Arrow, each
        distinct piece is looked up once, and the ids are laid out by numpy."""
        if not self.by_word:
            yield from map(self.encode, texts.to_pylist())
            return
        size = pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64)
        chunk = (np.cumsum(size) - size) // CHUNK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(texts)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield from self._chunk(texts.slice(a, b - a))

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of one text (null: none)."""
        if not text:
            return np.empty(0, self.dtype)
        if not self.by_word:
            return np.frombuffer(self._library(text), self.dtype)
        return np.frombuffer(b"".join([self[w] for w in text.encode("utf-8").split()]), self.dtype)


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """This worker's encoder of ``path`` (kept between tasks)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def crc_of(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, keep_ids: bool = False) -> DataFrame:
    """Documents (doc_id, text) cut into pieces of at most ``capacity`` ids, the
    end id included; with ``keep_ids`` also the ids (little-endian uint32).
    A null or empty text is one piece holding the end id; a null doc_id is kept."""

    def step(batch):
        enc = encoder(path)
        rows = ([], [], [], [], [], [])
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = np.append(enc.encode(text).astype("<u4"), np.uint32(end_id))
            for k, a in enumerate(range(0, len(ids), capacity)):
                part = ids[a:a + capacity]
                for col, v in zip(rows, (doc, k, a, len(part), zlib.crc32(part.tobytes()),
                                         part.tobytes() if keep_ids else None)):
                    col.append(v)
        return dict(zip(("doc_id", "piece", "start", "length", "ids_crc32", "ids"), rows))

    return map_arrow(docs.select("doc_id", "text"), step, PIECES + (", ids binary" if keep_ids else ""))
