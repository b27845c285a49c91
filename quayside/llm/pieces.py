"""SentencePiece encoding and decoding by a table of distinct chunks.

No piece of the vocabulary has the space marker after another character, so no merge crosses the start of a marked
word, and a text's ids are those of its marked words put one after the other. Each task keeps a table of the distinct
marked words it has met, segments each once with the library, and joins the ids back by position. The table is
bounded: when it is full it starts anew.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


class ChunkTable:
    """A SentencePiece model, and ids of the marked words met so far."""

    def __init__(self, path: str, most: int = 200_000):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        crossing = [p for p in map(self.model.id_to_piece, range(len(self.model)))
                    if re.search(f"[^{MARK}]{MARK}", p)]
        if crossing or self.model.encode(" a  b ", out_type=str) != self.model.encode(
                " a", out_type=str) + self.model.encode(" b", out_type=str) + [MARK]:
            raise ValueError("pieces of this model cross space markers, or it changes white space")
        self.alone = [self.model.piece_to_id(MARK)]
        self.most, self.table = most, {}

    def chunks(self, text: str) -> list[str]:
        """The text's marked words without their first marker. An empty text has none."""
        if not text:
            return []
        if "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        marked = MARK + text.replace(" ", MARK)
        return [c[1:] for c in CHUNK.findall(marked)]

    def learn(self, chunks: set[str]) -> None:
        """Segment chunks that are not in the table. The library sets the first marker itself."""
        new = [c for c in chunks if c not in self.table]
        if len(self.table) + len(new) > self.most:
            self.table.clear()
            new = list(chunks)
        spaced = [c.replace(MARK, " ") for c in new]
        for c, ids in zip(new, self.model.encode(spaced, num_threads=1)):
            ids = ids if c else self.alone
            self.table[c] = (",".join(map(str, ids)), ids)

    def encode(self, texts: list[str]) -> Iterator[tuple[str, list[int]]]:
        """For each text its ids as decimal text, and as a list. Texts are taken in groups of bounded size."""
        group, size = [], 0
        for text in texts:
            group.append(self.chunks(text))
            size += len(group[-1])
            if size >= 100_000:
                yield from self._encode(group)
                group, size = [], 0
        yield from self._encode(group)

    def _encode(self, group: list[list[str]]) -> Iterator[tuple[str, list[int]]]:
        self.learn(set().union(*group))
        for chunks in group:
            found = [self.table[c] for c in chunks]
            ids: list[int] = []
            for _, more in found:
                ids += more
            yield ",".join([text for text, _ in found]), ids


_TABLES: dict[str, ChunkTable] = {}  # one per worker process and model


def chunk_table(path: str) -> ChunkTable:
    if path not in _TABLES:
        _TABLES[path] = ChunkTable(path)
    return _TABLES[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array of int), decoded (the ids' text).

    A null text is empty and has no ids. Ties and repeats are encoded each by themselves, other columns are ignored,
    an empty table gives no rows.
    """
    def run(batches):
        table = chunk_table(path)
        for b in batches:
            found = [ids for _, ids in table.encode([t or "" for t in b.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int32())),
                                              pa.array([table.model.decode(x) for x in found], pa.string())],
                                             names=["doc_id", "ids", "decoded"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """The same with digests instead of ids and texts: n_tokens, ids_sha256, decoded_sha256. Nothing but digests
    leaves the task."""
    def run(batches):
        table = chunk_table(path)
        for b in batches:
            rows = []
            for text, ids in table.encode([t or "" for t in b.column(1).to_pylist()]):
                rows.append((len(ids), hashlib.sha256(text.encode()).hexdigest(),
                             hashlib.sha256(table.model.decode(ids).encode()).hexdigest()))
            n, a, d = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()),
                                              pa.array(d, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)
