"""Near-duplicates with carried columns: rows of one doc_id are judged each by its own text."""

from dispensa.llm import minhash_dedup


def test_texts_of_one_doc_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(3, a, "x"), (5, a, "y"), (5, b, "z"), (6, None, "n"), (6, a, "m"), (None, a, "k"), (7, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = minhash_dedup.near_duplicates(docs, keep=["source", "text"]).collect()
    assert {(r["source"], r["component_id"], r["kept"]) for r in found} == {("x", 3, True), ("y", 3, False), ("z", 5, True), ("n", 6, True), ("m", 3, False), ("k", None, True), ("e", 7, True)}
    assert {(r["doc_id"], r["text"], r["source"]) for r in found} == set(rows)
