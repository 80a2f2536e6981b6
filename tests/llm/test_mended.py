"""Cases that once lost rows, gave wrong ids or crashed."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard

from propal.llm import bpe, decontaminate, exact_dedup, substring_dedup


def test_many_vocabularies_in_one_session(spark):
    """Each query is encoded by its own vocabulary, however many a session has used."""
    docs = spark.createDataFrame([(1, "ab ab")], "doc_id long, text string").coalesce(1)
    single = [bytes([k]) for k in range(256)]
    for k in range(12):
        tokens = [*single, b"ab"] if k % 2 else [*single[::-1], b"xy"]
        shared = bpe._Shared(spark, bpe.Vocabulary(tokens, public_tokenizers.PATTERN))
        ids = bpe.encode(docs, shared).first()["ids"]
        assert b"".join(tokens[i] for i in ids) == b"ab ab"
        assert ids == ([256, 32, 256] if k % 2 else [158, 157, 223, 158, 157])
        del shared


def test_exact_dedup_drops_rows_not_documents(spark):
    rows = [(1, "only here"), (1, "shared"), (2, "SHARED"), (2, None), (3, ""), (None, "shared"), (None, "alone")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, text_sha256 string, kept int")
    kept = sorted(((r["doc_id"], r["text"]) for r in exact_dedup.keep_owners(docs).collect()), key=repr)
    assert kept == sorted([(1, "only here"), (2, "SHARED"), (3, ""), (None, "shared"), (None, "alone")], key=repr)


def test_benchmark_items_without_an_id(spark):
    passage = "the quick brown fox jumps over the lazy dog while seven wizards mix potions near quiet rivers tonight"
    docs = spark.createDataFrame([(1, f"before {passage} after"), (2, "nothing of it"), (None, passage)], "doc_id long, text string")
    items = spark.createDataFrame([(None, passage), (5, "another text of enough words to be an item that nobody has copied yet at all"),
                                   (None, None)], "item_id long, text string")
    found = decontaminate.contaminated(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, None), (None, None)}
    assert [r["doc_id"] for r in decontaminate.keep_clean(docs, items).collect()] == [2]


def test_suffixes_of_a_bucket_are_hashed_once(monkeypatch):
    own, press = np.random.default_rng(7), zstandard.ZstdCompressor()
    texts, parcels, hashed = {}, [], []
    for batch in range(9):
        rows = [bytes(own.integers(97, 99, 76).astype(np.uint8)) if k else b"x" * 76 for k in range(4)]
        docs = own.integers(0, 50, 4)
        texts[batch] = list(zip(docs.tolist(), rows))
        parcels.append((5, batch, np.arange(0, 400, 100).astype("<u4").tobytes(), np.full(4, 27).astype("u1").tobytes(),
                        press.compress(docs.astype("<i8").tobytes()), press.compress(b"".join(rows))))
    sums = substring_dedup.prefix_sums
    monkeypatch.setattr(substring_dedup, "prefix_sums", lambda data, base: hashed.append(1) or sums(data, base))
    names = ("bucket", "batch", "starts", "counts", "docs", "data")
    marks = substring_dedup._bucket_marks(pa.table(dict(zip(names, map(list, zip(*parcels))))))
    assert len(hashed) == 9
    least: dict = {}
    for doc, row in (x for rows in texts.values() for x in rows):
        for k in range(27):
            least[row[k:k + 50]] = min(doc, least.get(row[k:k + 50], doc))
    expected = {(batch, 100 * j, k) for batch, rows in texts.items() for j, (doc, row) in enumerate(rows) for k in range(27)
                if least[row[k:k + 50]] < doc}
    got = {(b, s, k) for b, ss, ms in zip(*(marks.column(c).to_pylist() for c in ("batch", "starts", "marks")))
           for s, m in zip(np.frombuffer(ss, "<u4").tolist(), np.frombuffer(ms, "<u4").tolist()) for k in range(27) if m >> k & 1}
    assert got == expected and got
