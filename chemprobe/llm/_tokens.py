"""Encoding of whole texts by a tokenizers file, with a bounded cache of the pieces between blanks."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Texts are cut before each single blank or line end that stands between two other characters. No
#: token of either public vocabulary spans such a place and no pattern looks back across it, so the
#: pieces are encoded independently of each other. `\s` is wider here than in the vocabularies' own
#: patterns, which only makes fewer cuts.
_CUT = re.compile(r"(?<=\S)([ \n])(?=\S)")
#: A cache holds two generations of at most about so many pieces, none longer than the second number.
_KEEP_PIECES, _KEEP_LENGTH = 420_000, 64


def pieces(text: str) -> list[str]:
    """The text in pieces that are encoded independently.

    A piece after the first that does not begin with a line end stands for itself after a blank.
    """
    if text.replace("\n", " ") == " ".join(text.split()):  # no white space but single blanks and line ends
        return text.replace("\n", " \n").split(" ")
    parts = _CUT.split(text)
    return [parts[0], *(b if a == " " else a + b for a, b in zip(parts[1::2], parts[2::2]))]


class PieceCache:
    """Little-endian 32-bit ids of texts, from a function that encodes pieces to such bytes.

    Pieces that were not used since the last but one time that the cache filled up are forgotten. Letters
    with a comma or full stop after them are two pre-tokens in either vocabulary, so they are put together
    from the two.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode, self.young, self.old = encode, {}, {}
        self.stops = dict(zip(",.", encode([",", "."])))

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > _KEEP_PIECES:
            self.young, self.old = {}, self.young
        young, old, cut, firsts = self.young, self.old, [], []
        for t in texts:
            ps = pieces(t)
            firsts.append(ps[0])
            del ps[0]
            cut.append(ps)
        new, ended = set(), []
        for p in set(chain.from_iterable(cut)).difference(young):
            if p in old:
                young[p] = old[p]
            elif p[-1] in ",." and p[:-1].isalpha():
                ended.append(p)
                stem = p[:-1]
                if stem in old:
                    young[stem] = old[stem]
                elif stem not in young:
                    new.add(stem)
            else:
                new.add(p)
        new = list(new)
        raws = self.encode([p if p[0] == "\n" else " " + p for p in new] + firsts)
        young.update(zip(new, raws))
        for p in ended:
            young[p] = young[p[:-1]] + self.stops[p[-1]]
        heads = raws[len(new) :]
        out = [h + b"".join(map(young.__getitem__, ps)) for h, ps in zip(heads, cut)]
        for p in new:
            if len(p) > _KEEP_LENGTH:
                del young[p]
        return out


_encoders: dict[str, PieceCache] = {}


def library_encoder(path: str) -> PieceCache:
    """This process's encoder by the tokenizers library, without special tokens, truncation or padding."""
    if path not in _encoders:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _encoders[path] = PieceCache(_marked(tokenizer) if tokenizer.normalizer is None else lambda ps: _apart(tokenizer, ps))
    return _encoders[path]


def as_bytes(ids: Iterable[int]) -> bytes:
    return array("I", ids).tobytes()


def _apart(tokenizer, ps: list[str]) -> list[bytes]:
    return [as_bytes(e.ids) for e in tokenizer.encode_batch_fast(ps, add_special_tokens=False)]


def _marked(tokenizer, lot: int = 200):
    """Encodes pieces many at a time, with a special token between them, which costs less than one by one."""
    mark, number = next(((t.content, k) for k, t in tokenizer.get_added_tokens_decoder().items() if t.special), (None, None))

    def run(ps: list[str]) -> list[bytes]:
        if mark is None:
            return _apart(tokenizer, ps)
        out: list[bytes] = []
        lots = [ps[k : k + lot] for k in range(0, len(ps), lot)]
        for some, e in zip(lots, tokenizer.encode_batch_fast([mark.join(x) for x in lots], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            cuts = np.flatnonzero(ids == number).tolist()
            if len(cuts) != len(some) - 1:  # a piece holds the mark itself
                out += _apart(tokenizer, some)
                continue
            raw = ids.tobytes()
            out += [raw[4 * a : 4 * b] for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, len(ids)])]
        return out

    return run


def in_lots(texts: Iterable[str | None], size: int = 4_000_000) -> Iterable[list[str]]:
    """Lists of texts of about `size` characters together; null is the empty text."""
    lot, n = [], 0
    for text in texts:
        lot.append(text or "")
        n += len(lot[-1])
        if n >= size:
            yield lot
            lot, n = [], 0
    if lot:
        yield lot
