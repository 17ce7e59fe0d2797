"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is cut at every step from a visible character to the space mark. No piece of
the vocabulary spans such a step (this is verified when a model is loaded), so each
unit can be merged on its own; by the same rule a unit is cut further between any two
characters that stand side by side in no piece. Each part has an agenda of its
adjacent symbol pairs, ordered by piece score and then by place from the left, which
is worked off until no pair is a piece. Symbols left over that are no pieces fall
back to bytes. Units and parts repeat a great deal, so every worker keeps a bounded
store of those done.

Every part that is new to a worker is checked against the sentencepiece library, all
new parts of a text in one call; where the two differ the job fails. Whole texts are
compared in the tests.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridmill.llm.common import documents
from gridmill.llm.units import Store

SPACE = "▁"
LOW = float("-inf")
#: Piece types of the public model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Model:
    """A vocabulary file, with the merge agenda over it."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            blob = file.read()
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        if trainer.model_type != 2 or not trainer.byte_fallback:
            raise ValueError("a merge-type model with byte fallback is needed")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError("a model with the identity normaliser is needed")
        if any(p.type in (USER, UNUSED) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not served")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.end = self.library.eos_id()
        self.raw = {i: p.piece.replace(SPACE, " ").encode() for i, p in enumerate(proto.pieces) if p.type == NORMAL} | {i: bytes([b]) for b, i in self.bytes.items()}
        self.beside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece spans a step to a space mark")

    def parts(self, unit: str) -> list[str]:
        """The unit, cut where no piece has the two characters side by side."""
        beside, cuts, start = self.beside, [], 0
        for i in range(1, len(unit)):
            if unit[i - 1 : i + 1] not in beside:
                cuts.append(unit[start:i])
                start = i
        cuts.append(unit[start:])
        return cuts

    def merged(self, part: str) -> list[int]:
        """The ids of one part, by the agenda."""
        if len(part) > 48:
            return self._merged_long(part)
        sym, scores = list(part), self.scores
        agenda = [scores.get(a + b, LOW) for a, b in zip(sym, sym[1:])]
        while agenda and (best := max(agenda)) > LOW:
            i = agenda.index(best)
            sym[i : i + 2] = [sym[i] + sym[i + 1]]
            del agenda[i]
            if i < len(agenda):
                agenda[i] = scores.get(sym[i] + sym[i + 1], LOW)
            if i:
                agenda[i - 1] = scores.get(sym[i - 1] + sym[i], LOW)
        return self._ids(sym)

    def _ids(self, sym: list[str]) -> list[int]:
        found: list[int] = []
        for s in sym:
            if s in self.ids:
                found.append(self.ids[s])
            else:
                found.extend(self.bytes[b] for b in s.encode())
        return found

    def _merged_long(self, unit: str) -> list[int]:
        """As ``merged``, with the agenda in a heap; entries whose symbols have changed meanwhile are passed over."""
        sym: list[str | None] = list(unit)
        n = len(sym)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        scores = self.scores
        agenda = [(-scores[pair], i, pair) for i in range(n - 1) if (pair := unit[i : i + 2]) in scores]
        heapq.heapify(agenda)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            a = sym[i]
            if a is None or (j := right[i]) >= n or len(pair) != len(a) + len(sym[j]) or a + sym[j] != pair:
                continue
            sym[i], sym[j] = pair, None
            right[i] = j = right[j]
            if j < n:
                left[j] = i
                if (new := pair + sym[j]) in scores:
                    heapq.heappush(agenda, (-scores[new], i, new))
            if (h := left[i]) >= 0 and (new := sym[h] + pair) in scores:
                heapq.heappush(agenda, (-scores[new], h, new))
        return self._ids([s for s in sym if s is not None])

    def units(self, text: str) -> list[str]:
        """The text under the space mark, cut before each run of marks that follows something visible."""
        if not text:
            return []
        parts = (self.prefix + text.replace(" ", SPACE)).split(SPACE)
        if "" not in parts[1:]:
            return ([parts[0]] if parts[0] else []) + [SPACE + p for p in parts[1:]]
        units, marks = ([parts[0]] if parts[0] else []), ""
        for p in parts[1:]:
            marks += SPACE
            if p:
                units.append(marks + p)
                marks = ""
        return [*units, marks] if marks else units

    def checked(self, units: list[str]) -> list[list[int]]:
        """The ids of the parts or units, each compared with what the library makes of it."""
        ours = [self.merged(u) for u in units]
        # The library puts a mark of its own in front; a line feed, which merges with nothing, keeps it apart from the unit.
        lead = self.library.encode("\n")
        for unit, a, b in zip(units, ours, self.library.encode(["\n" + u for u in units], num_threads=1)):
            if lead + a != b:
                raise ValueError(f"the agenda and the library differ on {unit!r}: {a} and {b[len(lead) :]}")
        return ours

    def values(self, parts: list[str]) -> list[tuple[int, str, bytes]]:
        """For each part its number of ids, the ids in decimal and the bytes they spell."""
        return [(len(ids), " ".join(map(str, ids)), self.decoded(ids)) for ids in self.checked(parts)]

    def joined(self, values: list[tuple]) -> tuple[int, str, bytes]:
        return sum([v[0] for v in values]), " ".join([v[1] for v in values]), b"".join([v[2] for v in values])

    def decoded(self, ids: list[int]) -> bytes:
        """The UTF-8 text that the ids spell, before the leading mark is taken off; ids with no text spell nothing."""
        return b"".join(self.raw.get(i, b"") for i in ids)

    def text_of(self, spelled: bytes) -> str:
        """As the library does: one leading space goes. Ids of a text spell its own UTF-8; other bytes are an error."""
        if self.prefix and spelled[:1] == b" ":
            spelled = spelled[1:]
        return spelled.decode("utf-8", "strict")


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


@lru_cache(maxsize=2)
def store(path: str) -> Store:
    """The worker's own store; a reused worker finds it filled."""
    return Store(model(path))


def encoded(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, and ``ids`` and ``decoded`` if asked for.

    Ids end with the end id and have no begin id. Null texts count as empty: one id,
    an empty decoded text. Repeated rows and null ids each get a row; an empty table
    gives none; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, kept = model(model_path), store(model_path)
        end = str(m.end)
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column(1).to_pylist():
                units = m.units(text or "")
                parts = kept.of_units(units)
                ids = " ".join([p[1] for p in parts] + [end])
                text_back = m.text_of(b"".join([p[2] for p in parts]))
                rows.append((sum([p[0] for p in parts]) + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text_back.encode()).hexdigest(), *((list(map(int, ids.split(" "))), text_back) if with_ids else ())))
            columns = list(zip(*rows)) or [()] * (5 if with_ids else 3)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: 1 + len(columns)])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
