"""Token ids of a public byte-level BPE, computed once per distinct chunk.

A chunk is a run of white space and the run of other bytes after it.  The
pre-tokenizer of byte-level BPE never joins two chunks, as long as all white
space is ASCII; texts with other white space are encoded whole."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa

from . import textvec as V

#: White space that is not [\x20\x09-\x0D].
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: Distinct chunks that one worker remembers (about 40 bytes each).
CACHE = 750_000

_open: dict[str, "ChunkEncoder"] = {}


def encoder(path: str) -> "ChunkEncoder":
    """One encoder per Python worker and vocabulary."""
    if path not in _open:
        _open[path] = ChunkEncoder(path)
    return _open[path]


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level BPE files write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ChunkEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.fast = self._ranked(path)
        self.forget()

    def _ranked(self, path: str):
        """The same vocabulary as ranks, which encodes short strings faster; None if ids don't follow the order of merges."""
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items() if all(c in alphabet for c in token)}
        special = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        for s in special:
            ranks.pop(s.encode(), None)
        merged = [ranks.get(bytes(alphabet[c] for c in "".join(m if isinstance(m, list) else m.split(" "))), -1) for m in model["merges"]]
        if merged != sorted(merged) or -1 in merged:
            return None
        found = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.piece = found._core_bpe.encode_single_piece
        return found.encode_ordinary

    def encode(self, text: str) -> list[int]:
        """A space and letters are one piece, and so is one comma or full stop after them; all else is split by the pattern."""
        if not self.fast:
            return self.whole.encode(text, add_special_tokens=False).ids
        word = text[1:] if text[0] == " " else text
        if word.isalpha():
            return self.piece(text.encode())
        if word[-1:] in (".", ",") and word[:-1].isalpha():
            return self.piece(text[:-1].encode()) + self.piece(text[-1].encode())
        return self.fast(text)

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        encoded = [self.encode(t) for t in texts]
        sizes = np.fromiter(map(len, encoded), np.int32, len(encoded))
        flat = np.fromiter((i for e in encoded for i in e), np.int32, int(sizes.sum()))
        at = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, flat])
        order = np.argsort(all_keys := np.concatenate([self.keys, keys]), kind="stable")
        self.keys, self.at, self.size = all_keys[order], np.concatenate([self.at, at])[order], np.concatenate([self.size, sizes])[order]

    def encode_slice(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by document) of the documents in one slice of bytes."""
        starts, ends, doc = V.words(data, off)
        begin = np.empty_like(starts)  # of the chunk: where the word before ended, or the document began
        begin[1:] = np.where(doc[1:] == doc[:-1], ends[:-1], off[doc[1:]]) if len(starts) else 0
        if len(starts):
            begin[0] = off[doc[0]]
        tail = off[:-1].copy()  # what follows the last word
        np.maximum.at(tail, doc, ends)
        rest = np.flatnonzero(tail < off[1:])
        begin, ends, doc = np.concatenate([begin, tail[rest]]), np.concatenate([ends, off[1:][rest]]), np.concatenate([doc, rest])
        order = np.lexsort((begin, doc))
        begin, ends, doc = begin[order], ends[order], doc[order]
        keys = V.hashes(data, begin, ends)
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > CACHE:
            self.forget()
        where = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = where < len(self.keys)
        known[inside] = self.keys[where[inside]] == distinct[inside]
        if not known.all():
            new = np.flatnonzero(~known)
            raw = data.tobytes()
            self._learn(distinct[new], [raw[begin[i] : ends[i]].decode("utf-8", "replace") for i in first[new]])
            where = np.searchsorted(self.keys, distinct)
        at, size = self.at[where][back], self.size[where][back].astype(np.int64)
        total = np.cumsum(size)
        ids = self.ids[np.repeat(at - (total - size), size) + np.arange(int(total[-1]) if len(total) else 0)]
        per_doc = np.zeros(len(off), np.int64)
        np.add.at(per_doc, doc + 1, size)
        return ids, np.cumsum(per_doc)

    def documents(self, column: pa.Array):
        """Yields the id array of every text of a column, in order; a null is empty."""
        column = column.cast(pa.large_string()).fill_null("")
        data, off = V.flat(column)
        for first, end, part, offsets in V.slices(data, off):
            ids, at = self.encode_slice(part, offsets)
            raw = part.tobytes()
            added = [t for t in self.added if t in raw]
            plain = not added and part.max(initial=0) < 128 and not np.isin(part, [0x1C, 0x1D, 0x1E, 0x1F]).any()
            for i in range(end - first):
                if not plain:
                    own = raw[offsets[i] : offsets[i + 1]]
                    text = own.decode("utf-8", "replace")
                    if ODD_SPACE.search(text) or any(t in own for t in added):
                        yield np.asarray(self.whole.encode(text, add_special_tokens=False).ids, np.int32)
                        continue
                yield ids[at[i] : at[i + 1]]
