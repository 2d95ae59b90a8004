"""Token ids by the ``tokenizers`` library, at lower cost.

Texts of a byte-level tokenizer are encoded by tiktoken from the same file's
vocabulary, whose ids are the ranks. A tokenizer that drops white space is
given each distinct word once; ids are kept in a bounded cache of the Python
worker, and plain lower-case words go straight to the tokenizer's model. Texts
with special tokens or very long white space go through ``tokenizers`` whole.
Ids equal those of encoding the whole text with ``tokenizers``.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

#: Words kept by one worker; rarer words are encoded again.
MAX_WORDS = 600_000
#: Characters of text handled at once.
GROUP_CHARS = 2_000_000

# How a file's texts may be taken apart: as the bytes of ranked tokens, or by words.
RANKED, WORDS = "ranked", "words"
KINDS = {"byte_bpe_50k.json": RANKED, "word_bpe_49k.json": WORDS}

# Plain text: ASCII without the separators that only some count as white space,
# Latin letters whose lower case is one of them too, and common marks. In it the
# tokenizer's own word pattern needs no Unicode classes.
LETTERS = "a-z\u00df-\u00f6\u00f8-\u017f"
PLAIN = re.compile("[\x00-\x1b\x20-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
                   "\u2013\u2014\u2018\u2019\u201c\u201d\u2026\u20ac]*")
#: Fixed value: the word pattern of the file, for plain text in lower case.
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\\s{LETTERS}0-9]+")
#: Words that this pattern cannot split: letters, or ASCII marks but an apostrophe.
ONE = re.compile(f"[{LETTERS}]+|[!-&(-/:-@\\[-`{{-~]+")
#: tiktoken's pattern needs a stack as deep as a run of white space is long.
LONG_SPACE = re.compile(r"\s{200}")
#: Python counts these as white space, the tokenizers' patterns do not.
SEPARATORS = re.compile("[\x1c-\x1f]")

_loaded: dict[str, Encoder] = {}


class _Ids(dict):
    """Ids of words; ``extra`` holds those of the present group only."""

    def __init__(self):
        super().__init__()
        self.extra: dict[str, bytes] = {}

    def __missing__(self, key):
        return self.extra[key]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = KINDS.get(os.path.basename(path))
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = _Ids()
        self.model = self.tokenizer.model
        self.ranked = byte_level(path) if self.kind == RANKED else None

    @property
    def dtype(self) -> str:
        return "<u4" if self.wide else "<u2"

    def _bytes(self, ids: list[int]) -> bytes:
        out = array("I" if self.wide else "H", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _whole(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _split(self, text: str) -> list[str] | None:
        """Words of a text; None: encode it whole."""
        if any(s in text for s in self.special) or SEPARATORS.search(text):
            return None
        return WORD.findall(text.lower()) if PLAIN.fullmatch(text) else text.split()

    def _learn(self, wanted: set[str]) -> None:
        cache, tokenize = self.words, self.model.tokenize
        cache.extra.clear()
        keep = cache if len(cache) < MAX_WORDS else cache.extra
        other = []
        for w in wanted:
            if w in cache:
                continue
            if ONE.fullmatch(w) and w == w.lower():
                symbols = w if w.isascii() else w.encode().decode("latin-1").translate(SYMBOLS)
                keep[w] = self._bytes([t.id for t in tokenize(symbols)])
            else:
                other.append(w)
        for w, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            keep[w] = self._bytes(e.ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian bytes of ``dtype``."""
        if self.ranked is not None:
            return [self._whole(t) if any(s in t for s in self.special) or LONG_SPACE.search(t)
                    else self._bytes(self.ranked.encode_ordinary(t)) for t in texts]
        if self.kind is None:
            return [self._whole(t) for t in texts]
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            group, size = [], 0
            while at < len(texts) and (not group or size + len(texts[at]) <= GROUP_CHARS):
                group.append(texts[at])
                size += len(texts[at])
                at += 1
            split = [self._split(t) for t in group]
            self._learn({w for ws in split if ws for w in ws})
            out += [self._whole(t) if ws is None else b"".join(map(self.words.__getitem__, ws))
                    for t, ws in zip(group, split, strict=True)]
        return out


def byte_symbols() -> dict[int, str]:
    """Byte -> the printable character that stands for it in byte-level files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


SYMBOLS = byte_symbols()


def byte_level(path: str):
    """tiktoken over the vocabulary of a byte-level file: a token's id is its rank."""
    import public_tokenizers
    import tiktoken
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    byte = {c: b for b, c in SYMBOLS.items()}
    ranks = {bytes(byte[c] for c in w): i for w, i in vocab.items() if all(c in byte for c in w) and not w.startswith("<|")}
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file, loaded once."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def default_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
