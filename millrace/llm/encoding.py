"""Token ids of whole texts by the ``tokenizers`` library, with a memory of words already encoded."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from millrace.llm.common import slices

#: Fixed value: the split pattern of the word-level vocabulary.  No alternative of it matches white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: Characters whose canonical form is themselves and whose lower case is the same in any context and library.
_PLAIN = regex.compile(r"[\x21-\x7e\u00a1-\u00ac\u00ae-\u012f\u0131-\u017f]+")
_PARTS = regex.compile(WORD_PATTERN)
#: The same on lower-cased ASCII text without white space.
_ASCII_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: Bytes of the longest word that is kept.
_KEPT = 64


def byte_characters() -> dict[int, str]:
    """Byte-level vocabularies write bytes as characters: printable Latin-1 ones as themselves, others from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


def _told(part) -> dict:
    return {} if part is None else json.loads(part.__getstate__())


def splits_at_spaces(library: Tokenizer) -> bool:
    """Whether a text's ids are those of its white-space-separated words, one after the other.

    True if white space is dropped before the merges, no normaliser looks across it and no added token holds it.
    """
    steps = _told(library.normalizer).get("normalizers", [])
    before = _told(library.pre_tokenizer).get("pretokenizers", [])
    first = before[0] if before else {}
    return (
        all(s["type"] in ("NFC", "Lowercase") or s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} for s in steps)
        and {"NFC", "Lowercase"} <= {s["type"] for s in steps}
        and first.get("type") == "Split" and first.get("pattern") == {"Regex": WORD_PATTERN}
        and first.get("behavior") == "Removed" and bool(first.get("invert"))
        and all(p["type"] == "ByteLevel" and not p.get("add_prefix_space") for p in before[1:])
        and not any(t.lstrip or t.rstrip or t.single_word or set(t.content) & set(" \t\n\r\x0b\x0c")
                    for t in library.get_added_tokens_decoder().values())
    )


class WordEncoder:
    """Encodes texts exactly as ``Tokenizer.encode(text, add_special_tokens=False)`` does.

    Where the vocabulary drops white space, texts are split at white space and their words numbered by Arrow, a few
    megabytes at a time, so Python sees each distinct word of a portion once; any other vocabulary encodes whole texts.
    Words and parts of words keep their ids in two generations of about ``words`` entries: when the young one is full it
    becomes the old one, and an entry that is met again moves back, so common words are never encoded anew.

    Most of the library's time for a new word goes into normalising and splitting, so words of plain Latin letters,
    digits and marks are split here and only their new parts go to the library's merges; every other word takes the
    library's whole path.
    """

    def __init__(self, path: str, words: int = 300_000):
        self.library = Tokenizer.from_file(path)
        self.by_word = splits_at_spaces(self.library)
        self.words = words
        self.model, shown = self.library.model, byte_characters()
        self.shown = {b: c for b, c in shown.items() if chr(b) != c}
        self.added = regex.compile("|".join(regex.escape(t.content) for t in self.library.get_added_tokens_decoder().values()) or "(?!)")
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}

    @property
    def bits(self) -> int:
        """Least width that holds every id of the vocabulary."""
        return max(1, (self.library.get_vocab_size(with_added_tokens=True) - 1).bit_length())

    def _merge(self, part: str) -> bytes:
        """Ids of a part by the library's merges."""
        written = part if part.isascii() else part.encode().decode("latin-1").translate(self.shown)
        return array("I", [t.id for t in self.model.tokenize(written)]).tobytes()

    def _split(self, raw: bytes) -> list[str] | None:
        """Parts of a plain word."""
        word = raw.decode("utf-8", "replace")
        if word.isascii():
            if word.isprintable() and not self.added.search(word):
                return _ASCII_PARTS.findall(word.lower())
        elif _PLAIN.fullmatch(word) and not self.added.search(word):
            return _PARTS.findall(word.lower())
        return None

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """Ids of words not met before."""
        parts, old, out = self.parts, self.old_parts, []
        for raw in words:
            own = [raw.lower().decode()] if raw.isalpha() else self._split(raw)
            if own is None:
                out.append(array("I", self.library.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes())
                continue
            found = []
            for part in own:
                ids = parts.get(part)
                if ids is None:
                    ids = parts[part] = old.get(part) or self._merge(part)
                found.append(ids)
            out.append(found[0] if len(found) == 1 else b"".join(found))
        if len(parts) > self.words:
            self.old_parts, self.parts = parts, {}
        return out

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words as bytes.  Very long words are not kept, so entries have a bounded size."""
        young, out = self.young, list(map(self.young.get, words))
        missing = [i for i, ids in enumerate(out) if ids is None]
        again = list(map(self.old.get, [words[i] for i in missing]))
        unknown = [words[i] for i, ids in zip(missing, again, strict=True) if ids is None]
        learned = iter(self._learn(unknown))
        for i, ids in zip(missing, again, strict=True):
            out[i] = ids = next(learned) if ids is None else ids
            if len(words[i]) <= _KEPT:
                young[words[i]] = ids
        if len(young) > self.words:
            self.old, self.young = young, {}
        return out

    def _numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and each text's number of ids."""
        split = pc.ascii_split_whitespace(texts)
        numbered = split.values.dictionary_encode()
        found = self._ids(numbered.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
        count = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        flat, first = np.frombuffer(b"".join(found), np.uint32), np.cumsum(count) - count
        at = numbered.indices.to_numpy()
        own = count[at]
        ends = np.cumsum(own)
        ids = flat[np.repeat(first[at] - ends + own, own) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[split.offsets.to_numpy()]
        return ids, np.diff(bounds)

    def encode_batch(self, texts: pa.Array, portion: int = 4 << 20) -> Iterator[np.ndarray]:
        """Ids of each text (null: none) of a string column as unsigned 32-bit values, in order."""
        if not self.by_word:
            for text in texts.to_pylist():
                yield np.array(self.library.encode(text, add_special_tokens=False).ids if text else [], np.uint32)
            return
        texts = texts.fill_null("")
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            before = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + portion, side="right")))
            if ends[at] - before > portion:
                pieces = [self._numbered(pa.array([p], pa.binary()).cast(pa.string()))[0] for p in slices(texts[at].as_py().encode())]
                yield np.concatenate(pieces)
            else:
                ids, counts = self._numbered(texts.slice(at, end - at))
                bounds = np.concatenate([[0], np.cumsum(counts)]).tolist()
                yield from (ids[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True))
            at = end

    def encode(self, text: bytes | None) -> np.ndarray:
        """Ids of one whole text (null: none) as unsigned 32-bit values."""
        return next(self.encode_batch(pa.array([text], pa.binary()).cast(pa.string())))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of a process: Spark keeps its Python workers, so a later task goes on with the words of earlier ones."""
    return WordEncoder(path)
