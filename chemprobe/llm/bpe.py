"""Byte-pair encoding by a bounded-lookahead streaming transducer, and incremental decoding.

Within one pre-token, whether a merge of u and v happens at a place depends on the right only as far
as v and the merges of higher priority that could take v's end away, which again depend on their own
right parts. Priorities rise along such a chain, so it ends; the longest one is the merge list's
sufficient lookahead. A token that lies that far before the end of what has been read is stable
whatever follows, so it is emitted and its bytes are dropped: memory is constant in the text's length.
A boundary between tokens, once stable, also parts the rest: the encoding of what follows it does not
depend on what came before.

Texts are streams in the same way. What arrives is held only as far back as the last place that no
pre-token can span whatever follows; a pre-token that goes on beyond that is fed to its transducer in
parts. Pre-tokens that were met before are looked up in a bounded cache of the transducer's results.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemprobe.llm._shared import bound_batches
from chemprobe.llm._tokens import PieceCache, as_bytes, in_lots

#: Characters of a text that are fed to its stream at a time.
CHUNK = 1 << 18
#: Fixed value: the pattern that byte-level vocabularies of this kind split texts by.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary's file.

    Printable bytes stand for themselves; the others follow from code point 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Transducer:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab, special = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        self.bytes_of = [b""] * size
        for word, k in vocab.items():
            if word not in special:
                self.bytes_of[k] = bytes(letters[c] for c in word)
        for word, k in special.items():
            self.bytes_of[k] = word.encode()
        self.byte_id = [0] * 256
        for letter, b in letters.items():
            self.byte_id[b] = vocab[letter]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        pairs = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            u, v, w = vocab[left], vocab[right], vocab[left + right]
            self.merge.setdefault((u, v), (rank, w))
            pairs.append((u, v, w))
        self.lookahead = self._sufficient_lookahead(pairs)
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.split = regex.compile(SPLIT)
        self.cache = PieceCache(lambda ps: [as_bytes(self.encode_piece(p)) for p in ps])

    def _sufficient_lookahead(self, pairs: list[tuple[int, int, int]]) -> int:
        """Bytes after a token that can still change it: one pass over the merges by rising priority number."""
        right_part: dict[int, int] = {}
        reach: dict[int, int] = {}  # the longest reach so far of a merge whose left side is this token
        most = 0
        for u, v, w in pairs:
            longest, x = 0, v
            while True:
                longest = max(longest, reach.get(x, 0))
                if x not in right_part:
                    break
                x = right_part[x]
            own = len(self.bytes_of[v]) + longest
            reach[u] = max(reach.get(u, 0), own)
            right_part.setdefault(w, v)
            most = max(most, own)
        return most

    def _merged(self, ids: list[int]) -> list[int]:
        merge = self.merge
        while len(ids) > 1:
            best = None
            for pair in zip(ids, ids[1:]):
                found = merge.get(pair)
                if found is not None and (best is None or found < best):
                    best, at = found, pair
            if best is None:
                break
            (u, v), w, out, k, n = at, best[1], [], 0, len(ids)
            while k < n:
                if k + 1 < n and ids[k] == u and ids[k + 1] == v:
                    out.append(w)
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        return ids

    def stream(self, chunks: Iterable[bytes]) -> Iterator[int]:
        """The ids of one pre-token that arrives in chunks, each as soon as it is stable."""
        piece = PreToken(self)
        for chunk in chunks:
            yield from piece.push(chunk)
        yield from piece.finish()

    def encode_piece(self, text: str) -> list[int]:
        """The ids of a text in which no pre-token is open at either end."""
        ids: list[int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                ids.append(self.special[part])
                continue
            for m in self.split.finditer(part):
                ids.extend(self.stream([m.group().encode()]))
        return ids

    def parts(self, text: str, step: int = CHUNK) -> Iterator[bytes]:
        """A text's ids as little-endian 32-bit numbers, in parts as they become stable."""
        stream = TextStream(self)
        for at in range(0, len(text), step):
            yield stream.push(text[at : at + step])
        yield stream.finish()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text. Texts of one step share a look into the cache."""
        short = iter(self.cache([t for t in texts if len(t) <= CHUNK]))
        return [next(short) if len(t) <= CHUNK else b"".join(self.parts(t)) for t in texts]

    def decode(self, ids: np.ndarray, step: int = 4096) -> Iterator[str]:
        """The text of ids in parts."""
        state = Decoder(self)
        for at in range(0, len(ids), step):
            yield state.push(ids[at : at + step])
        yield state.finish()


class Decoder:
    """From ids to text: keeps the bytes of an unfinished character between calls."""

    def __init__(self, coder: Transducer):
        self.of, self.state = coder.bytes_of, codecs.getincrementaldecoder("utf-8")(errors="replace")

    def push(self, ids: np.ndarray) -> str:
        return self.state.decode(b"".join(map(self.of.__getitem__, ids.tolist())))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


class PreToken:
    """One pre-token's bytes as they arrive; at most two lookaheads and one token of them are held."""

    __slots__ = ("coder", "held")

    def __init__(self, coder: Transducer):
        self.coder, self.held = coder, b""

    def push(self, chunk: bytes) -> list[int]:
        """The ids that are stable with `chunk`."""
        coder, far, out = self.coder, self.coder.lookahead, []
        for at in range(0, len(chunk), far):
            held = self.held = self.held + chunk[at : at + far]
            if len(held) <= 2 * far:
                continue
            stable, done = len(held) - far, 0
            for k in coder._merged([coder.byte_id[b] for b in held]):
                n = len(coder.bytes_of[k])
                if done + n > stable:
                    break
                out.append(k)
                done += n
            self.held = held[done:]
        return out

    def finish(self) -> list[int]:
        held, self.held = self.held, b""
        return self.coder._merged([self.coder.byte_id[b] for b in held])


#: The kinds of characters that a pre-token can go on with, by what its last one is.
_KINDS = [regex.compile(x) for x in (r"\p{L}*+", r"\p{N}*+", r"\s*+", r"[^\s\p{L}\p{N}]*+")]


class TextStream:
    """The encoder of one text that arrives in parts; holds a part and a few lookaheads at most."""

    def __init__(self, coder: Transducer):
        self.coder, self.held = coder, ""
        self.open: PreToken | None = None  # a long pre-token, and the kind of character it consists of
        self.kind = _KINDS[0]

    def _tail(self, text: str) -> int:
        """The characters at a text's end that may begin a special token."""
        for k in range(min(max(map(len, self.coder.special), default=1) - 1, len(text)), 0, -1):
            if any(word.startswith(text[-k:]) for word in self.coder.special if len(word) > k):
                return k
        return 0

    def _stable(self, text: str) -> int:
        """The last place found that no pre-token spans whatever follows; 0 if there is none."""
        best = 0
        if self.coder.cut:
            for m in self.coder.cut.finditer(text):
                best = m.end()
        for sign in " \n":  # a single one between other characters begins a pre-token, or is one
            k = text.rfind(sign, 1, len(text) - 1)
            while k > best and (text[k - 1].isspace() or text[k + 1].isspace()):
                k = text.rfind(sign, 1, k)
            best = max(best, k)
        if not best:  # two characters on, neither a contraction nor white space can change
            last = len(text) - max(2, self._tail(text) + 1)
            for m in self.coder.split.finditer(text):
                if m.end() > last:
                    break
                best = m.end()
        return best

    def _goes_on(self, text: str, final: bool) -> tuple[str, bool]:
        """Feeds the open pre-token; what is left of `text`, and whether it is still open."""
        room = len(text) if final else len(text) - self._tail(text)
        m = self.coder.cut.search(text) if self.coder.cut else None
        n = min(self.kind.match(text).end(), m.start() if m else room, room)
        ended = final or n < room or m is not None and n == m.start()
        if self.kind is _KINDS[2] and not (final and n == len(text)) and not (m and n == m.start()):
            n = max(n - 1, 0)  # the last white space before another character is not of the run
        self.out += self.open.push(text[:n].encode())
        if ended:
            self.out += self.open.finish()
            self.open = None
        return text[n:], not ended

    def push(self, text: str) -> bytes:
        """The ids that are stable with `text`."""
        self.out: list[int] = []
        text = self.held + text
        if self.open:
            text, still = self._goes_on(text, False)
            if still:
                self.held = text
                return as_bytes(self.out)
        ids = as_bytes(self.out)
        if cut := self._stable(text):
            ids += self.coder.cache([text[:cut]])[0]
            text = text[cut:]
        if len(text) > 4 * self.coder.lookahead and (m := self.coder.split.match(text)):
            self.out, self.open = [], PreToken(self.coder)
            self.kind = next(k for k in _KINDS if k.match(m.group()[-1]).end())
            lead = m.group()[0] if self.kind is not _KINDS[2] and m.group()[0] == " " else ""
            self.out += self.open.push(lead.encode())
            text, _ = self._goes_on(text[len(lead) :], False)
            ids += as_bytes(self.out)
        self.held = text
        return ids

    def finish(self) -> bytes:
        """The ids of what is left when the text ends."""
        self.out, text = [], self.held
        if self.open:
            text, _ = self._goes_on(text, True)
        self.held = ""
        return as_bytes(self.out) + (self.coder.cache([text])[0] if text else b"")


_loaded: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """This process's transducer of a vocabulary file."""
    if path not in _loaded:
        _loaded[path] = Transducer(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of each row of `docs` (doc_id, text); null is the empty text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = transducer(path)
        for batch in batches:
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for lot in in_lots(batch["text"]) for x in coder.encode(lot)]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "ids": ids})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of each row of `tokens` (doc_id, ids); null is no ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = transducer(path)
        for batch in batches:
            texts = ["".join(coder.decode(np.asarray(x if x is not None else [], np.int64))) for x in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text": texts})

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInPandas(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256. One map, no shuffle.

    Null and empty texts have no tokens. Repeated rows give repeated results. A long text goes through its
    stream, and its ids through the decoder, in parts: no more than a part of its ids is held at a time.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = transducer(path)
        for batch in batches:
            rows = []
            for lot in in_lots(batch["text"]):
                short = iter(coder.encode([t for t in lot if len(t) <= CHUNK]))
                for whole in lot:
                    n, ids, text, back = 0, hashlib.sha256(), hashlib.sha256(), Decoder(coder)
                    for raw in [next(short)] if len(whole) <= CHUNK else coder.parts(whole):
                        n += len(raw) // 4
                        ids.update(raw)
                        text.update(back.push(np.frombuffer(raw, "<u4")).encode())
                    text.update(back.finish().encode())
                    rows.append((n, ids.hexdigest(), text.hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out

    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op9_bpe(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Every document encoded, and decoded again."""
    import public_tokenizers

    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), path)
