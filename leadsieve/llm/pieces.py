"""Word caches for tokenizers that never look across white space.

Texts repeat their words, so a task encodes each distinct piece once and joins kept results. What a cache holds is
bounded; beyond the bound it starts anew, which costs time and changes no result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadsieve.llm.common import whole

MOST = 250_000
LONGEST = 64

#: In Latin-1 texts: marks, signs and other things than letters and digits before a full stop or comma.
_RUNS = re.compile(r"[!-/:-@\[-`{-~\x80-\xbf\xd7\xf7][.,][ \n]")


class Kept(dict):
    """piece -> result of make(piece). Holds two generations of at most `most` pieces of at most LONGEST characters.

    When the young one is full it becomes the old one; a piece found in the old one is young again.
    """

    def __init__(self, make: Callable[[str], object], most: int = MOST):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, piece: str):
        made = self.old.get(piece)
        if made is None:
            made = self.make(piece)
            if isinstance(piece, str) and len(piece) > LONGEST:
                return made
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[piece] = made
        return made


def latin(text: str) -> bool:
    """Whether all characters are Latin-1: then it is in NFC, and lower case is a matter of single characters."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def chunks(text: str, lone_marks: bool) -> list[str]:
    """The text cut at blanks and line ends, which no token of the supported tokenizers contains.

    lone_marks (for Latin-1 texts, and tokenizers that part runs of letters, digits and other marks): full stops and
    commas after letters and digits become pieces of their own, so that fewer pieces differ.
    """
    if lone_marks and not _RUNS.search(text):
        text = text.replace(".\n", " . ").replace(". ", " . ").replace(", ", " , ")
    return text.replace("\n", " ").split(" ")


def slices(batches: Iterator, rows: int = 256) -> Iterator:
    """Arrow batches as small ones, so that only few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def per_text(docs: DataFrame, doc_id: str, text: str, fields: str, tool: Callable, row: Callable) -> DataFrame:
    """doc_id and what row(tool(), text) gives, for each document; null text is empty text.

    fields may be long, string and array<int>.
    """
    import pyarrow as pa
    narrow = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    schema = T.StructType([narrow.schema["doc_id"], *T.StructType.fromDDL(fields).fields])
    plain = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    kinds = [plain[f.dataType.simpleString()] for f in schema.fields[1:]]

    def run(batches):
        made = tool()
        for batch in slices(batches):
            columns = zip(*[row(made, t) for t in batch.column(1).to_pylist()], strict=True)
            own = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *own], names=schema.names)

    return narrow.mapInArrow(run, schema)
