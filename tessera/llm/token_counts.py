"""Token counts by a compiled transducer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import over_texts
from tessera.llm.transducer import transducer


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """Count the tokens of each text: (doc_id, n_bytes, n_tokens, over_limit).

    No shuffle: rows are worked where they are read, in blocks of bounded size. A null or empty text
    has no bytes and no tokens; repeated rows and null ids give a row each; further columns are not
    read. A text of any length is cut into chunks that run side by side (see `transducer`).
    path: a byte-level BPE in the `tokenizers` format, at the same place on all machines.
    """

    def work(rest, parts):
        n = transducer(path).counts(parts)
        return {
            "doc_id": rest.column(0),
            "n_bytes": pa.array(np.fromiter(map(len, parts), np.int64, len(parts))),
            "n_tokens": pa.array(n),
            "over_limit": pa.array(n > limit),
        }

    narrow = docs.select(F.col("doc_id"), F.col("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return over_texts(narrow, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", work, 2 << 20)
