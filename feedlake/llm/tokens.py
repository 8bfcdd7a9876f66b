"""Token ids of whole texts with the public tokenizers, remembered piece by piece.

Both vocabularies split a text into words before anything is merged, so the ids of a text are those of
its words in a row, and most words come again and again. A text of plain letters, digits, signs, spaces and line ends
is split into its words here, and each word is given to the tokenizer's model once. In any other text a piece is what
stands between two spaces; plain pieces are split into words as well, other pieces go to the whole tokenizer.

Many plain texts are split together by the kinds of their bytes, and a word is looked up once for all its places in them.
"""

from __future__ import annotations

import gc
import re
import struct
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Entries that a task's memory of pieces and of words holds at once, each.
REMEMBERED = 1_000_000
#: Longer ones are encoded anew each time.
MAX_REMEMBERED = 48
#: Characters of the texts that are split together; a longer text is split alone.
GROUP_CHARS = 1 << 20

_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"  # without the dotted capital I, whose lower case is two characters
_SIGNS = r"!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"  # without the apostrophe, which may begin a word ending
_PLAIN = re.compile(rf"(?:[{_LETTERS}]++|[0-9]++|[{_SIGNS}]++|\n(?=[^\n]))++")  # possessive, as a run may be long and something else follow it
_WORDS = re.compile(rf"[{_LETTERS}]+|[0-9]+|[{_SIGNS}]+|\n")
_SINGLE_DIGITS = re.compile(rf"[{_LETTERS}]+|[0-9]|[{_SIGNS}]+")
_NOT_PLAIN = re.compile(rf"[^{_LETTERS}0-9{_SIGNS} \n]|<\|")
_TEXT_WORDS = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+| ?[{_SIGNS}]+|\s+(?!\S)|\s+")
_AFTER_WORD = re.compile(r"(?<=\S) ")
_ODD_SPACES = re.compile(r"^ |\s ")

#: Kinds of the UTF-8 bytes of plain texts.
_ENDS, _WHITE, _LETTER, _DIGIT, _SIGN, _OTHER = range(6)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[0] = _ENDS  # stands behind each text
_KINDS[[*b" \n"]] = _WHITE
_KINDS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = _LETTER
_KINDS[[*b"0123456789"]] = _DIGIT
_KINDS[[*rb"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""]] = _SIGN
_PLAIN_BYTES = bytes(np.flatnonzero((_KINDS != _ENDS) & (_KINDS != _OTHER)).tolist())
#: What the plain bytes can write beside plain texts.
_NOT_PLAIN_PARTS = ("\u00d7", "\u00f7", "\u0130", "<|")


def _is_plain(text: str) -> bool:
    """True for what ``_NOT_PLAIN`` is not found in."""
    return not text.encode().translate(None, _PLAIN_BYTES) and not any(part in text for part in _NOT_PLAIN_PARTS)


def _word_starts(data: bytes, spaces_belong: bool) -> np.ndarray:
    """Where the words of plain texts begin, each text with a zero byte behind it; stretches of white space and zeros count as words."""
    own, kinds = np.frombuffer(data, np.uint8), _KINDS[np.frombuffer(data, np.uint8)]
    starts = np.ones(len(own), bool)
    np.not_equal(kinds[1:], kinds[:-1], out=starts[1:])
    if spaces_belong:  # the last white character of several stands alone, and a space goes with the word behind it
        word = kinds > _WHITE
        starts[1:] &= ~(word[1:] & (own[:-1] == 0x20))
        starts[:-1] |= word[1:] & (kinds[:-1] == _WHITE)
    else:
        starts |= kinds == _DIGIT
    return np.flatnonzero(starts)


def _byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: visible ones for themselves, others from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Remembered(dict):
    """Key -> ids as little-endian unsigned 32-bit integers. When full, the older half of what it holds is forgotten."""

    def __init__(self, make):
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self.make(key)
        if len(key) <= MAX_REMEMBERED:
            if len(self) >= REMEMBERED // 2:
                self.older = dict(self)
                self.clear()
            self[key] = ids
        return ids


class Encoder:
    """Ids of a text, equal to those that the tokenizer gives for the whole text.

    A single space after a character that is no white space always begins a new word, and nothing looks back across it,
    so the text may be cut there. ``spaces_belong``: the space is part of the word that it begins; else spaces only
    separate words, letters are lower-cased and digits stand alone.
    """

    def __init__(self, path: str, spaces_belong: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.spaces_belong = spaces_belong
        byte_chars = _byte_characters()
        self.table = {c: "".join(byte_chars[b] for b in chr(c).encode()) for c in range(0x180)}
        self.words = Remembered(self._word)
        self.first = Remembered(lambda piece: self._piece("", piece))
        self.later = Remembered(lambda piece: self._piece(" ", piece)) if spaces_belong else self.first

    def _word(self, word: str) -> bytes:
        plain = word.isascii() and word.isalpha()
        ids = [t.id for t in self.model.tokenize(word if plain else word.translate(self.table))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, lead: str, piece: str) -> bytes:
        if not _PLAIN.fullmatch(piece) or "<|" in piece or (lead and piece[0] == "\n"):
            ids = self.tokenizer.encode(lead + piece, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        if not self.spaces_belong:
            return b"".join(map(self.words.__getitem__, _SINGLE_DIGITS.findall(piece.lower())))
        words = _WORDS.findall(piece)
        words[0] = lead + words[0]
        return b"".join(map(self.words.__getitem__, words))

    def ids(self, text: str | None) -> bytes:
        """The ids of a whole text; none for a null or empty one."""
        if not text:
            return b""
        if not _NOT_PLAIN.search(text):
            found = _TEXT_WORDS.findall(text) if self.spaces_belong else _SINGLE_DIGITS.findall(text.lower())
            return b"".join(map(self.words.__getitem__, found))
        if not self.spaces_belong:
            return b"".join(map(self.first.__getitem__, text.replace("\n", " ").split(" ")))
        pieces = text.split(" ") if not _ODD_SPACES.search(text) else _AFTER_WORD.split(text)
        return self.first[pieces[0]] + b"".join(map(self.later.__getitem__, pieces[1:]))

    def ids_of_each(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """``ids`` of every text, in order."""
        group, chars = [], 0
        for text in texts:
            group.append(text)
            chars += len(text or "")
            if chars >= GROUP_CHARS:
                yield from self._of_group(group)
                group, chars = [], 0
        yield from self._of_group(group)

    def _of_group(self, texts: list[str | None]) -> Iterator[bytes]:
        plain = [bool(text) and _is_plain(text) for text in texts]
        found = self._of_plain([text for text, is_plain in zip(texts, plain) if is_plain])
        for text, is_plain in zip(texts, plain):
            yield next(found) if is_plain else self.ids(text)

    def _of_plain(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each of some plain texts; every distinct word of theirs is looked up once."""
        if not texts:
            return
        joined = "\0".join([*texts, ""])
        data = (joined if self.spaces_belong else joined.lower()).encode()
        starts = np.append(_word_starts(data, self.spaces_belong), len(data))
        words = pa.Array.from_buffers(pa.large_string(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64, copy=False)), pa.py_buffer(data)])
        words = words.dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        ends = np.flatnonzero(words.indices.to_numpy() == distinct.index("\0")) + 1
        without_ids = {"\0"} if self.spaces_belong else {word for word in distinct if word == "\0" or word.isspace()}
        ids = pa.array([b"" if word in without_ids else self.words[word] for word in distinct], pa.large_binary()).take(words.indices)
        bounds = np.frombuffer(ids.buffers()[1], np.int64)[ends].tolist()
        own = memoryview(ids.buffers()[2] or b"")
        del words, distinct, starts, data
        for start, end in zip([0, *bounds], bounds):
            yield own[start:end].tobytes()


def ids_of_each(encoder, texts: Iterable[str | None]) -> Iterator[bytes]:
    """The ids of every text, in order, by any encoder: one that has only ``ids`` gets text by text."""
    return encoder.ids_of_each(texts) if hasattr(encoder, "ids_of_each") else map(encoder.ids, texts)


def vocabulary_path(name: str) -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@cache  # one per Python worker, so that what it remembers serves all its tasks
def byte_encoder(path: str | None = None) -> Encoder:
    return Encoder(path or vocabulary_path("byte_bpe_50k.json"), spaces_belong=True)


@cache
def word_encoder(path: str | None = None) -> Encoder:
    return Encoder(path or vocabulary_path("word_bpe_49k.json"), spaces_belong=False)


def forget() -> None:
    """Lets go of this worker's encoders, for tasks that do not encode."""
    if byte_encoder.cache_info().currsize or word_encoder.cache_info().currsize:
        byte_encoder.cache_clear()
        word_encoder.cache_clear()
        gc.collect()  # what they remember refers back to them
