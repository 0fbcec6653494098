"""A worker takes only some texts of a batch at once; rows and their order stay."""

from __future__ import annotations

import pyarrow as pa

from skyledger.llm import toxicity


def test_batches_are_scored_in_pieces():
    model = toxicity.Model(b"plain words of text " * 300, b"other words of text " * 300, b" plain context ")
    texts = [None if k % 7 == 0 else f"word{k} plain" for k in range(1_203)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1_203)), "text": texts})
    out = list(toxicity._scored(iter([batch]), toxicity._Scorer(model), ["doc_id", "text"]))
    assert [b.num_rows for b in out] == [500, 500, 203]
    assert pa.Table.from_batches(out).select(["doc_id", "text"]).equals(pa.Table.from_batches([batch]))
    assert out[0].schema.names == ["doc_id", "text", "score"]
