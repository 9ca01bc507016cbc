"""Token ids of texts by a tokenizer file, for use inside Arrow tasks.

Byte-level pair encoding first cuts a text before each blank that stands alone, so a text's ids
are those of its blank-led parts one after the other.  Arrow cuts all texts at once and names the
different parts.  Those seen before come from a bounded memory; new ones are encoded by the
tokenizers library, words of letters many at a time.  Texts with other blanks (several in a row,
or at an end) are encoded whole.

By default the strings of special tokens are ordinary text.  With `special_ids` the tokenizer
stays as loaded and gives the ids of special tokens where a text holds their strings, as its
plain `encode(text, add_special_tokens=False)` does.
"""

from __future__ import annotations

import os
import string
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Symbols of the byte-level alphabet: printable bytes stand for themselves, others follow from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SYMBOLS = np.arange(256, dtype="<u2")
_SYMBOLS[[b for b in range(256) if b not in _PRINTABLE]] = np.arange(256, 512 - len(_PRINTABLE))
#: Ends a part; words of letters don't hold it.
_CUT = "\x1f"
_SYMBOLS[ord(_CUT)] = ord(_CUT)


@lru_cache(maxsize=1)
def shared_encoder(path: str, special_ids: bool = False) -> Encoder:
    """The encoder of a Python worker, whose tasks come one after the other and know more and more parts."""
    return Encoder(path, limit=1_000_000, special_ids=special_ids)


class Encoder:
    """Ids of whole texts, as little-endian unsigned 16-bit ids where the vocabulary allows, else 32-bit."""

    def __init__(self, path: str, limit: int = 1_500_000, special_ids: bool = False) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        if not special_ids:
            self.tokenizer.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder().values()
        #: Strings that the library cuts out of a text before anything else.
        self._added = [t.content for t in added if t.content and (special_ids or not t.special)]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        #: The pair encoding of units that are cut already.
        self._units = Tokenizer(self.tokenizer.model)
        self._units.pre_tokenizer = CharDelimiterSplit(_CUT)
        vocabulary = self.tokenizer.get_vocab()
        #: Bytes that a token stands for, by id.
        self._sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self._sizes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.limit = limit
        self._known: dict[str, bytes | None] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids by the library alone."""
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes of `dtype`."""
        out: list[bytes] = []
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size < 1 << 23):
                size += len(texts[stop])
                stop += 1
            out += self._encode(texts[start:stop])
            start = stop
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        given = pa.array(texts, pa.large_string())
        # A text with a part that can't stand alone is encoded whole.
        whole = reduce(pc.or_, [pc.match_substring(given, s) for s in (_CUT, *self._added)])
        marked = pc.if_else(whole, " ", given)
        for blank in " \n":
            marked = pc.replace_substring(marked, blank, _CUT + blank)
        parts = pc.split_pattern(marked, _CUT)
        named = parts.values.dictionary_encode()
        names = named.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [p for p in names if p not in self._known]
        if len(self._known) + len(new) > self.limit:
            self._known = {p: self._known[p] for p in names if p in self._known}
        self._learn(new)
        ids = pa.array([self._known[p] for p in names], pa.large_binary()).take(named.indices)
        joined = pc.binary_join(pa.ListArray.from_arrays(parts.offsets, ids), pa.scalar(b"", ids.type)).to_pylist()
        return [self.whole([text])[0] if own is None else own for text, own in zip(texts, joined, strict=True)]

    def _learn(self, parts: list[str]) -> None:
        """Ids of new parts; None for those whose ids depend on what stands beside them."""
        known = self._known
        words: set[str] = set()
        uses: list[tuple[str, str, str, str]] = []
        others: set[str] = set()
        for part in parts:
            if part[1:].isalpha() and part[0] == " ":
                words.add(part)
                continue
            core = part.rstrip(string.punctuation)
            lead, end = "", part[len(core) :]
            if core[1:].isalpha() and core[0] == "\n":
                lead, core = core[0], core[1:]
            if core.isalpha() or (core[:1] == " " and core[1:].isalpha()):
                uses.append((part, lead, core, end))
                if core not in known:
                    words.add(core)
            elif not part or part[-1].isspace() or (part[0].isspace() and part[1].isspace()):
                known[part] = None if part else b""
            else:
                others.add(part)
        units = [*words]
        for start in range(0, len(units), 1 << 14):
            some = units[start : start + (1 << 14)]
            known.update(zip(some, self._words(some), strict=True))
        beside = {"\n", *(end for *_, end in uses if end)}
        beside = dict(zip(beside, self.whole([*beside]), strict=True)) | {"": b""}
        known.update(zip(others, self.whole([*others]), strict=True))
        for part, lead, core, end in uses:
            known[part] = beside[lead] + known[core] + beside[end]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of letters, with or without a blank in front: each word is one unit for the pair encoding.

        The library gets many in one string; the bytes that the tokens stand for tell where a word ends.
        """
        raw = np.frombuffer((_CUT.join(words) + _CUT).encode(), np.uint8)
        cuts = np.flatnonzero(raw == ord(_CUT))
        symbols = _SYMBOLS[raw]
        edges = [0, *(cuts[99:-1:100] + 1).tolist(), len(raw)]
        strings = [symbols[a:b].tobytes().decode("utf-16-le") for a, b in zip(edges, edges[1:], strict=False)]
        found = self._units.encode_batch_fast(strings, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, self.dtype) for e in found])
        ends, wanted = np.cumsum(self._sizes[ids]), cuts - np.arange(len(cuts))
        stops = np.searchsorted(ends, wanted)
        if not len(ends) or ends[-1] != wanted[-1] or (ends[stops] != wanted).any():
            # Some byte has no token or one of another length.
            units = "".join(strings).split(_CUT)[:-1]
            return [np.array(e.ids, self.dtype).tobytes() for e in self._units.encode_batch_fast(units, add_special_tokens=False)]
        packed, size = ids.tobytes(), self.dtype.itemsize
        edges = [0, *((stops + 1) * size).tolist()]
        return [packed[a:b] for a, b in zip(edges, edges[1:], strict=False)]
