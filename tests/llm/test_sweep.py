"""Files of finished rounds go while near duplicates are still being found."""

from tessera.llm import near_duplicates as N
from tessera.llm.common import swept


def test_rounds_are_swept(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(N, "swept", lambda s: calls.append(s) or swept(s))
    words = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, words), (2, words + " more"), (3, "other words here that stand alone"), (4, words)], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 1}
    assert len(calls) >= N.ROUNDS + 3
