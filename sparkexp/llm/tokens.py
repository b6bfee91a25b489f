"""Token ids of whole texts, from a public vocabulary file.

The vocabulary's pre-tokenizer never joins text across a single white space
between two other characters: a space starts the token after it, a line feed is
a token of its own. Nor does it join a letter or digit with the punctuation after
it. So texts are cut there, Arrow numbers the distinct pieces of many texts, each of these is looked up
once, and the library encodes it once for as long as a worker remembers it; a word of letters goes straight to the library's model, in the
letters that stand for its bytes, as the steps before it would pass it on. A text with other
white space (runs, at either end, tabs beside a cut) is encoded whole.

A worker remembers two generations of pieces. When the young one has ``BYTES_KEPT`` it
becomes the old one, and pieces that are met again move to the new young one. So frequent pieces
stay, pieces that occur once go, and memory is bounded in bytes, however long a piece is.

With ``added_tokens`` a text is encoded as the library does by itself: the content of a
special token, such as ``<|endoftext|>``, gets that token's id. Without, it is text like
any other. A text in which an added token is recognised is encoded whole.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from sparkexp.llm.worker import kept

END_ID = 0
# What a generation of remembered pieces takes, and what a piece takes besides its text and ids.
BYTES_KEPT = 100_000_000
_PIECE_BYTES = 180
_ENDINGS_KEPT = 10_000
# Texts encoded at once have this share of the bytes kept in letters, and at most so many rows.
_LETTERS_SHARE = 8
_ROWS_AT_ONCE = 50_000
# Letters below this have long been letters for every library.
_OLD_LETTERS = "\u0530"


def _byte_letters() -> list[str]:
    """How byte-level vocabularies write each byte: visible Latin-1 letters as they are, others from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + others.index(b)) for b in range(256)]


_LETTERS = _byte_letters()
_SPACE = _LETTERS[32]
_BLANK = pa.scalar(" ", pa.large_string())
_FROM_LATIN = str.maketrans({chr(b): letter for b, letter in enumerate(_LETTERS)})


class _Pieces(dict):
    """Ids of a piece that follows a space, or, written with its line feed, a line feed. False: not to be cut there.

    A piece that is not here is taken from the older generation or encoded. A word with punctuation after it is put
    together from both and not remembered itself.
    """

    def __init__(self, make: Callable[[str], bytes | bool], ending: Callable[[str], bytes], older: dict[str, bytes | bool]) -> None:
        super().__init__()
        self.make, self.ending, self.older, self.size = make, ending, older, 0

    def __missing__(self, piece: str) -> bytes | bool:
        stem = piece.rstrip(string.punctuation)
        if stem and len(stem) < len(piece) and stem[-1].isalnum():
            ids = self[stem]
            return ids if ids is False else ids + self.ending(piece[len(stem) :])
        ids = self.older.get(piece)
        if ids is None:
            ids = self.make(piece)
        self[piece] = ids
        self.size += _PIECE_BYTES + len(piece) + (len(ids) if ids else 0)
        return ids


class TextEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, each followed by the end id."""

    def __init__(self, vocabulary: str, end_id: int = END_ID, bytes_kept: int = BYTES_KEPT, added_tokens: bool = False) -> None:
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = not added_tokens
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added if added_tokens or not token.special]
        self.bytes_kept = bytes_kept
        self.end = np.array([end_id], "<u4").tobytes()
        self.line = self._whole("\n")
        self.tokenize = self.tokenizer.model.tokenize
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        # Words may go to the model only if it does to them what the whole library does.
        self.plain = all(self._whole(word) == self._of_model(word) for word in (" probe", " Éléphantß", "probe", " жук"))
        self.known, self.endings = _Pieces(self._of_piece, self._of_ending, {}), {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _of_model(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(_FROM_LATIN)
        return b"".join([self.id_bytes[token.id] for token in self.tokenize(letters)])

    def _of_piece(self, piece: str) -> bytes | bool:
        """The ids of a piece that no generation has."""
        if self.plain and piece.isalpha():  # most are
            if piece.isascii():
                return b"".join([self.id_bytes[token.id] for token in self.tokenize(_SPACE + piece)])
            if max(piece) < _OLD_LETTERS:
                return self._of_model(" " + piece)
        at_line = piece[:1] == "\n"
        body = piece[1:] if at_line else piece
        if not body or body[0].isspace() or body[-1].isspace():
            return False
        if not at_line:
            return self._whole(" " + piece)
        if self.plain and body.isalpha() and max(body) < _OLD_LETTERS:
            return self.line + self._of_model(body)
        return self.line + self._whole(body)

    def _of_ending(self, ending: str) -> bytes:
        """The ids of punctuation that follows a letter or digit."""
        ids = self.endings.get(ending)
        if ids is None:
            if len(self.endings) > _ENDINGS_KEPT:
                self.endings.clear()
            ids = self.endings[ending] = self._whole(ending)
        return ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as bytes; null is empty."""
        if self.known.size > self.bytes_kept:
            older, self.known.older = self.known, {}
            self.known = _Pieces(self._of_piece, self._of_ending, older)
        out, cut = [self.end] * len(texts), []
        for i, text in enumerate(texts):
            if text and any(token in text for token in self.added):
                out[i] = self._whole(text) + self.end
            elif text:
                cut.append(i)
        if not cut:
            return out
        # The first piece is written as if a line feed came before it.
        lined = pa.array(["\n" + texts[i].replace("\n", " \n") for i in cut], pa.large_string())
        pieces = pc.split_pattern(lined, " ")
        numbered = pieces.flatten().dictionary_encode()
        # No piece holds a blank, so all distinct ones pass to Python as one text.
        distinct = pa.ListArray.from_arrays(pa.array([0, len(numbered.dictionary)], pa.int32()), numbered.dictionary)
        ids = list(map(self.known.__getitem__, pc.binary_join(distinct, _BLANK)[0].as_py().split(" ")))
        of, numbers, bounds = ids.__getitem__, numbered.indices.to_numpy(), pieces.offsets.to_pylist()
        for i, begin, end in zip(cut, bounds, bounds[1:]):
            try:
                out[i] = b"".join(map(of, numbers[begin:end].tolist()))[len(self.line) :] + self.end
            except TypeError:  # a False among them
                out[i] = self._whole(texts[i]) + self.end
        return out

    def encode_rows(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
        """The first column and the ids of the texts in the second, for many rows at once."""
        names, texts, size = [], [], 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names.append(name)
                texts.append(text)
                size += len(text or "")
                if size >= self.bytes_kept // _LETTERS_SHARE or len(names) >= _ROWS_AT_ONCE:
                    yield names, self.encode(texts)
                    names, texts, size = [], [], 0
        if names:
            yield names, self.encode(texts)


def encoder(vocabulary: str, added_tokens: bool = False, bytes_kept: int = BYTES_KEPT) -> TextEncoder:
    """The worker's encoder for a vocabulary file."""
    name = ("tokens", vocabulary, added_tokens, bytes_kept)
    return kept(name, lambda: TextEncoder(vocabulary, added_tokens=added_tokens, bytes_kept=bytes_kept))
