"""Tokenising whole texts with a public word-level BPE file.

The file's rules never join characters across ASCII white space, so a text's ids are the ids of its
white-space separated pieces in order. A piece of Latin-1 characters falls apart further into the
parts of the file's own split pattern. Pieces and parts repeat; each worker keeps the ids of those
it met, within a bound.
"""

from __future__ import annotations

import json
import os

from pairmill.llm.common import remembered

MAX_CACHED_BYTES = 48
MARKS = b".,!?;:#*$%&()"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder(dict):
    """Maps texts to ids, as little-endian unsigned 32-bit integers; holds the pieces met so far.

    ``cached`` bounds the number of remembered pieces, and of words; beyond it a memory starts anew.
    """

    def __init__(self, path: str, cached: int = 400_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        rules = json.loads(self.tokenizer.to_str())
        split = next(r for r in rules["pre_tokenizer"]["pretokenizers"] if r["type"] == "Split")
        self.split = regex.compile(split["pattern"]["Regex"]).findall
        self.cached = cached
        self.parts: dict[bytes, bytes] = {}

    def encode(self, data: bytes) -> bytes:
        """Ids of a text. Special tokens of the file are recognised as the library does."""
        # Lower case early lets more pieces repeat. Special tokens are matched before it, and
        # combining marks (first bytes cc and cd) join their letters before it.
        if b"<|" not in data and b"\xcc" not in data and b"\xcd" not in data:
            data = data.lower()
        return b"".join(map(self.__getitem__, data.split()))

    def __missing__(self, piece: bytes) -> bytes:
        word = piece.rstrip(MARKS)
        ids = self.parts.get(word)
        if ids is not None:
            tail = self.parts.get(piece[len(word):])
            ids = None if tail is None else ids + tail
        if ids is None:
            ids = self._piece(piece)
        if len(piece) <= MAX_CACHED_BYTES:
            if len(self) > self.cached:
                self.clear()
            self[piece] = ids
        return ids

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._whole(text)
        if "<|" in text:
            return self._whole(text)
        if len(self.parts) > self.cached:
            self.parts.clear()
        self.parts[b""] = b""
        out = []
        for part in self.split(text.lower()):
            data = part.encode()
            ids = self.parts.get(data)
            if ids is None:
                spelt = "".join([BYTE_LETTERS[b] for b in data])
                ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelt)])
                # Words and runs of marks split alike wherever they stand; "'s" and the like do not.
                if len(data) <= MAX_CACHED_BYTES and (part.isalpha() or not data.strip(MARKS)):
                    self.parts[data] = ids
            out.append(ids)
        return b"".join(out)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in ids])


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the others follow from 256 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


BYTE_LETTERS = _byte_letters()
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return remembered(("encoder", path), lambda: Encoder(path))
