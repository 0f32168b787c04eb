"""SentencePiece encoding and decoding by a table of last tokens.

Pair merging leaves tokens between which no merge would ever have won, and that
can be told from two neighbours alone. So each prefix of a text has exactly one
token it can end in: a piece that the automaton finds there, that merging makes of
its own letters, and that fits the last token of the prefix before it. The table of
these tokens takes one pass, and the ids are read off it backwards.

A text is cut where no piece of the vocabulary reaches across (before a run of
blanks, around letters that no piece has); a cut part is worked out once per task
and kept. Letters without a piece become the pieces of their bytes.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidegauge.llm.batches import map_partitions

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
# Parts and pairs kept by a task; the tables are emptied when full.
KEPT_PARTS = 1 << 19
KEPT_PAIRS = 1 << 20
LONGEST_KEPT = 48

_NONE = float("-inf")


class Vocabulary:
    """Pieces with scores and ids, and what encoding and decoding need of them.

    ``pieces`` maps a piece to (score, id): of two merges the higher score wins, of
    equal ones the left. ``byte_ids`` are the ids of the 256 single bytes.
    """

    def __init__(
        self, pieces: dict[str, tuple[float, int]], byte_ids: list[int], begin: int, end: int
    ) -> None:
        self.score = {p: s for p, (s, _) in pieces.items()}
        self.byte_ids, self.begin, self.end = byte_ids, begin, end
        letters = sorted({c for p in pieces for c in p})
        self.tokens = [p for p in pieces if self.merged(p)] + [c for c in letters if c not in pieces]
        self.size = [len(t) for t in self.tokens]
        self.ids = [[pieces[t][1]] if t in pieces else self.bytes_of(t) for t in self.tokens]
        known = "".join(map(re.escape, letters)).replace(re.escape(BLANK), "")
        crossed = any(BLANK in p.lstrip(BLANK) for p in pieces)
        inside = f"[{known}{BLANK}]+" if crossed else f"{BLANK}*[{known}]+|{BLANK}+"
        self.cut = f"{inside}|[^{known}{BLANK}]+" if known else f"{BLANK}+|[^{BLANK}]+"
        self._link()
        self.text_of = {i: p.replace(BLANK, " ").encode() for p, (_, i) in pieces.items()}
        self.text_of |= {i: bytes([b]) for b, i in enumerate(byte_ids)}

    def bytes_of(self, letter: str) -> list[int]:
        return [self.byte_ids[b] for b in letter.encode()]

    def steps(self, text: str) -> Iterator[tuple[float, str, str]]:
        """The merges of a text on its own: score, and the outer two symbols before it.

        The last one has no merge, and a score below all others.
        """
        symbols = list(text)
        while True:
            best, at = _NONE, -1
            for i in range(len(symbols) - 1):
                score = self.score.get(symbols[i] + symbols[i + 1], _NONE)
                if score > best:
                    best, at = score, i
            yield best, symbols[0], symbols[-1]
            if at < 0:
                return
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def merged(self, piece: str) -> bool:
        """Whether merging makes the piece of its own letters."""
        *_, (_, first, _) = self.steps(piece)
        return first == piece

    def fits(self, left: int, right: int) -> bool:
        """Whether the tokens stay apart when merging runs on both.

        Each goes through its own merges, the better of the two next ones first;
        they don't fit if the pair across the seam is ever better than both.
        """
        ours, theirs = self.steps(self.tokens[left]), self.steps(self.tokens[right])
        a, _, u = next(ours)
        b, v, _ = next(theirs)
        while True:
            across = self.score.get(u + v, _NONE)
            # of equal scores the one further left goes first
            if across > a and across >= b:
                return False
            if a == b == _NONE:
                return True
            if a >= b:
                a, _, u = next(ours)
            else:
                b, v, _ = next(theirs)

    def _link(self) -> None:
        """Trie, failure links, and per node the longest token that ends there.

        ``shorter`` leads from a token to the next one that is an end of it.
        """
        self.next: list[dict[str, int]] = [{}]
        own = [-1]
        for number, token in enumerate(self.tokens):
            node = 0
            for letter in token:
                child = self.next[node].get(letter)
                if child is None:
                    child = len(own)
                    self.next[node][letter] = child
                    self.next.append({})
                    own.append(-1)
                node = child
            own[node] = number
        self.fail, self.longest = [0] * len(own), list(own)
        self.shorter = [-1] * len(self.tokens)
        waiting = deque(self.next[0].values())
        while waiting:
            node = waiting.popleft()
            if own[node] >= 0:
                self.shorter[own[node]] = self.longest[self.fail[node]]
            else:
                self.longest[node] = self.longest[self.fail[node]]
            for letter, child in self.next[node].items():
                waiting.append(child)
                at = self.fail[node]
                while at and letter not in self.next[at]:
                    at = self.fail[at]
                self.fail[child] = self.next[at].get(letter, 0)


def read_model(path: str = MODEL) -> Vocabulary:
    """A BPE model with byte fallback and without text normalisation; read on the driver."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    form, trained = model.normalizer_spec, model.trainer_spec
    plain = form.add_dummy_prefix and form.escape_whitespaces and not (
        form.precompiled_charsmap or form.remove_extra_whitespaces or trained.treat_whitespace_as_suffix
    )
    if trained.model_type != trained.BPE or not trained.byte_fallback or not plain:
        raise ValueError(f"{path}: not a plain BPE model with byte fallback")
    kinds = model.SentencePiece
    if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
        raise ValueError(f"{path}: has user-defined or unused pieces")
    normal = {p.piece: (p.score, i) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
    of_byte = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
    byte_ids = [of_byte[f"<0x{b:02X}>"] for b in range(256)]
    return Vocabulary(normal, byte_ids, trained.bos_id, trained.eos_id)


class Codec:
    """Encodes and decodes texts, and keeps what it worked out."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.of = vocabulary
        self.parts_in = re.compile(vocabulary.cut).findall
        self.apart: dict[tuple[int, int], bool] = {}
        self.kept: dict[str, tuple[bytes, str]] = {}

    def _fits(self, left: int, right: int) -> bool:
        known = self.apart.get((left, right))
        if known is None:
            if len(self.apart) >= KEPT_PAIRS:
                self.apart.clear()
            known = self.apart[left, right] = self.of.fits(left, right)
        return known

    def last_tokens(self, part: str) -> list[int]:
        """For each prefix of the part its last token; -1 for a letter of no piece."""
        step, fail, longest = self.of.next, self.of.fail, self.of.longest
        shorter, size, fits = self.of.shorter, self.of.size, self._fits
        last: list[int] = []
        node = 0
        for i, letter in enumerate(part):
            while (child := step[node].get(letter)) is None and node:
                node = fail[node]
            node = child or 0
            token = longest[node]
            while token >= 0:
                before = i - size[token]
                if before < 0 or last[before] < 0 or fits(last[before], token):
                    break
                token = shorter[token]
            last.append(token)
        return last

    def ids(self, part: str) -> list[int]:
        last = self.last_tokens(part)
        found: list[list[int]] = []
        at = len(part)
        while at:
            token = last[at - 1]
            found.append(self.of.ids[token] if token >= 0 else self.of.bytes_of(part[at - 1]))
            at -= self.of.size[token] if token >= 0 else 1
        return [i for ids in reversed(found) for i in ids]

    def decoded(self, ids: Iterable[int]) -> str:
        """The text of ids, with the blank before it; begin and end ids have none."""
        return b"".join([self.of.text_of.get(i, b"") for i in ids]).decode("utf-8", "replace")

    def _part(self, part: str) -> tuple[bytes, str]:
        found = self.kept.get(part)
        if found is None:
            ids = self.ids(part)
            found = b"".join([i.to_bytes(4, "little") for i in ids]), self.decoded(ids)
            if len(part) <= LONGEST_KEPT:
                if len(self.kept) >= KEPT_PARTS:
                    self.kept.clear()
                self.kept[part] = found
        return found

    def coded(self, text: str) -> tuple[bytes, str]:
        """All ids as little-endian 32-bit numbers, and the text they decode to."""
        ends = self.of.begin.to_bytes(4, "little"), self.of.end.to_bytes(4, "little")
        if not text:
            return b"".join(ends), ""
        parts = [self._part(p) for p in self.parts_in(BLANK + text.replace(" ", BLANK))]
        ids = b"".join([ends[0], *[p[0] for p in parts], ends[1]])
        return ids, "".join([p[1] for p in parts])[1:]


def encoded(
    documents: DataFrame, vocabulary: Vocabulary | None = None, id_col: str = "doc_id"
) -> DataFrame:
    """One row per row of ``documents``: the id, ids (binary, 32-bit numbers), decoded.

    ``ids`` begins and ends with the begin and end ids. A null text is empty, and an
    empty text has these two alone. Rows don't meet, so repeated rows and null ids are
    kept as they are; other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary or read_model())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        codec = Codec(shared.value)
        for batch in batches:
            coded = [codec.coded(text or "") for text in batch.column("text").to_pylist()]
            yield {id_col: batch.column(id_col), "ids": [c[0] for c in coded], "decoded": [c[1] for c in coded]}

    kind = documents.schema[id_col].dataType.simpleString()
    return map_partitions(documents.select(id_col, "text"), task, f"`{id_col}` {kind}, ids binary, decoded string")
