"""Token ids of whole texts, through a cache of words.

The default vocabulary lower-cases, drops white space and never joins words
across it, so a text's ids are the ids of its lower-cased words in turn. Whether
a vocabulary does that is read from its file; one of another kind has its texts
encoded whole, by the tokenizers library alone. Most words of a corpus repeat: each is
encoded once and looked up afterwards. The cache keeps the words met first, most
of them frequent ones, and of later ones two generations of bounded size; long
texts are cut at white space into slices, so memory stays bounded.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from array import array

from rowcast.llm.shingles import byte_view, groups

SLICE = 1 << 20
CACHE_WORDS = 200_000
# Lower-case Latin-1 letters: the vocabulary's normalizer leaves such words alone,
# and its splitter makes them one group, so they go to the merges directly.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch
# ASCII marks that no rule of the vocabulary joins with a letter or digit before them.
_MARKS = b".,!?#$%&*;:)"
# Fixed value: how the default vocabulary's file cuts words.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACES = (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Default place of a vocabulary; callers may pass any other path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _shown_bytes() -> dict[int, int]:
    """Byte-level vocabularies write bytes as printable characters, the others from 256 on in turn."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [byte for byte in range(256) if byte not in printable]
    return {byte: 256 + i for i, byte in enumerate(hidden)}


def _slices(data: bytes):
    start = 0
    while len(data) - start > SLICE:
        end = max(data.rfind(space, start, start + SLICE) for space in _SPACES)
        if end < start:
            after = [at for space in _SPACES if (at := data.find(space, start + SLICE)) >= 0]
            end = min(after, default=len(data) - 1)
        yield data[start : end + 1]
        start = end + 1
    yield data[start:]


class _Words(dict):
    """Ids of words, as little-endian unsigned 32-bit bytes; an unknown word is encoded when asked for."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.shown = _shown_bytes()
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.recent.get(word)
        if ids is not None:
            return ids
        ids = self.older.get(word)
        if ids is None:
            # Marks after a letter or digit are a token group of their own.
            core = word.rstrip(_MARKS)
            if len(core) < len(word) and (core[-1:].isalnum() or _PLAIN(core.decode().lower())):
                ids = self[core] + self[word[len(core) :]]
            else:
                ids = self._encoded(word)
        if len(self) < CACHE_WORDS:
            self[word] = ids
        else:
            if len(self.recent) >= CACHE_WORDS // 2:
                self.older, self.recent = self.recent, {}
            self.recent[word] = ids
        return ids

    def _encoded(self, word: bytes) -> bytes:
        text = word.decode().lower()
        if _PLAIN(text):
            if len(text) < len(word):
                text = text.encode().decode("latin-1").translate(self.shown)
            return array("I", [token.id for token in self.model.tokenize(text)]).tobytes()
        return array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()


def _by_words(settings: dict) -> bool:
    """Whether a vocabulary file cuts lower-cased texts at white space and byte-encodes words of one kind, as ``_Words`` takes for granted."""
    steps = (settings.get("normalizer") or {}).get("normalizers") or []
    cuts = (settings.get("pre_tokenizer") or {}).get("pretokenizers") or []
    model = settings.get("model") or {}
    return (
        [step["type"] for step in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1].get("pattern") == {"Regex": "\\s+"}
        and steps[1].get("content") == " "
        and [cut["type"] for cut in cuts] == ["Split", "ByteLevel"]
        and cuts[0].get("pattern") == {"Regex": _SPLIT}
        and cuts[0].get("behavior") == "Removed"
        and cuts[0].get("invert") is True
        and not cuts[1].get("add_prefix_space")
        and model.get("type") == "BPE"
        and not model.get("dropout")
        # Marked pieces of a text would be tokens wherever they stand.
        and all(re.fullmatch(r"<\|\w+\|>", token["content"]) for token in settings.get("added_tokens") or [])
    )


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.words = _Words(self.tokenizer) if _by_words(json.load(file)) else None

    def encode(self, data: bytes) -> bytes:
        if self.words is None:
            return array("I", self.tokenizer.encode(data.decode(), add_special_tokens=False).ids).tobytes()
        found = []
        for part in _slices(data):
            found.append(b"".join(map(self.words.__getitem__, part.lower().split())))
        return found[0] if len(found) == 1 else b"".join(found)

    def encode_many(self, texts: list[bytes]) -> list[bytes]:
        return [self.encode(text) for text in texts]


def encoder(path: str) -> Encoder:
    """This worker's encoder; it stays with the process, so later tasks find its words known."""
    # Functions of this module travel with every task, so what stays is kept in a module of its own.
    kept = sys.modules.setdefault("_rowcast_encoders", types.ModuleType("_rowcast_encoders")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def text_groups(column):
    """Texts of an Arrow column as UTF-8 bytes, in groups of about a slice; NULL is empty."""
    content, starts, ends = byte_view(column)
    for part in groups(starts, ends, SLICE // 2):
        bounds = zip(starts[part].tolist(), ends[part].tolist())
        yield part, [content[a:b].tobytes() for a, b in bounds]
