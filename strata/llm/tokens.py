"""Token ids of whole texts by a public tokenizer, as bytes of unsigned integers in the machine's order.

Some tokenizers drop white space and never look across it (`WORDWISE` tells them by their settings). Then a text's ids are those of its
words one after the other, and what has been encoded is remembered. Texts of plain letters, digits and signs need no normalisation but lower
case, so that their pieces go straight to the library's BPE model; in other texts the other words, and of other tokenizers all texts, go
through the library's whole encoding.
"""

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Settings under which words can be encoded one by one: fixed values of the tokenizer's file.
WORDWISE = (
    ["NFC", "Replace", "Lowercase"],
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "ByteLevel",
)
#: Texts whose normal form is their lower case: Latin-1 letters, digits, signs that begin no contraction or special token, gaps.
PLAIN = re.compile(r"[A-Za-z0-9À-ÖØ-öø-ÿ!-&(-;=-@\[-`{-~ \t\n\r]*")
PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|\n|[^a-z0-9ß-öø-ÿ\n]+")
GAPS = str.maketrans("\t\n\r", "   ")
MOST_WORDS, MOST_PIECES = 50_000, 800_000


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies use for bytes: printable ones for themselves, the others numbered from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


def is_wordwise(settings: dict) -> bool:
    normalizers = [x["type"] for x in (settings.get("normalizer") or {}).get("normalizers", [])]
    steps = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        len(steps) == 2
        and (normalizers, steps[0].get("pattern", {}).get("Regex"), steps[1]["type"]) == WORDWISE
        and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
        and not any(t["lstrip"] or t["rstrip"] or not t["content"].strip() or set(t["content"]) & set(" \t\n\r") for t in settings["added_tokens"])
        and settings["model"]["type"] == "BPE" and not settings["model"]["dropout"]
    )


class Known(dict):
    """A memory of at most `most` entries; it is emptied when full."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


class TokenCoder:
    """Encodes texts by the tokenizer in `path`; one for each Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype(self.code)
        with open(path, encoding="utf-8") as file:
            self.wordwise = is_wordwise(json.load(file))
        self.letters = byte_letters()
        self.pieces = Known(self._piece, MOST_PIECES)
        self.words = Known(self._word, MOST_WORDS)

    def _piece(self, piece: str) -> bytes:
        if piece == "\n":  # stands between words
            return b""
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _word(self, word: str) -> bytes:
        if PLAIN.fullmatch(word):
            return self._plain_words(word.lower())[0].tobytes()
        return array(self.code, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _plain_words(self, words: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and where each word ends in it. Words are plain, in lower case, each ended by a newline."""
        pieces = PIECES.findall(words)
        ids = list(map(self.pieces.__getitem__, pieces))
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) // self.dtype.itemsize
        return np.frombuffer(b"".join(ids), self.dtype), ends[np.fromiter(map("\n".__eq__, pieces), bool, len(pieces))]

    def _plain_texts(self, texts: list[str]) -> list[bytes]:
        """Each different word is encoded once; its ids are then copied to all its places at once."""
        split = pc.utf8_split_whitespace(pa.array([t.lower() for t in texts], pa.large_string()))
        # White space at either end of a text leaves an empty word there.
        words = split.flatten().dictionary_encode()
        at = words.indices.to_numpy()
        different = words.dictionary
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(different)], different), pa.scalar("\n", pa.large_string()))[0].as_py()
        ids, ends = self._plain_words(joined + "\n" if len(different) else "")
        sizes = np.diff(ends, prepend=0)
        n = sizes[at]
        until = np.cumsum(n)
        copied = ids[np.repeat((ends - sizes)[at] - (until - n), n) + np.arange(int(n.sum()))]
        borders = np.concatenate(([0], until))[split.offsets.to_numpy()].tolist()
        return [copied[a:b].tobytes() for a, b in zip(borders, borders[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.wordwise:
            return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        out = [b"" if PLAIN.fullmatch(t) else b"".join(map(self.words.__getitem__, t.translate(GAPS).split(" "))) for t in texts]
        plain = [i for i, t in enumerate(texts) if PLAIN.fullmatch(t)]
        for i, ids in zip(plain, self._plain_texts([texts[i] for i in plain])):
            out[i] = ids
        return out


_coders: dict[str, TokenCoder] = {}


def coder(path: str) -> TokenCoder:
    """The worker's own coder of a tokenizer file."""
    if path not in _coders:
        _coders.clear()
        _coders[path] = TokenCoder(path)
    return _coders[path]
