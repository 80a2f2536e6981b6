"""Operators with a contract, against brute force, on given and edge-case rows."""

import random

import numpy as np
import public_tokenizers
import tiktoken

from propal.llm import bpe, exact_dedup, langid, secrets, simhash, substring_dedup
from tests.llm import brute


def same(frame, expected, columns=None):
    rows = frame.select(*columns).collect() if columns else frame.collect()
    order = lambda rs: sorted(map(tuple, rs), key=repr)
    assert order(rows) == order(expected)


BASE = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def test_secrets(small, edge, empty, pairs):
    path, docs, rows = small
    same(secrets.secret_digests(docs), brute.secrets(rows), BASE)
    same(secrets.secret_digests(edge), brute.secrets(pairs), BASE)
    assert secrets.secret_digests(empty).collect() == []


def test_secret_checksums():
    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    import zlib
    value, check = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        check = secrets.BASE62[d] + check
    find = secrets.automaton((secrets.ASSIGN, secrets.ACCESS, *secrets.MORE))
    good, bad = f"x ghp_{body}{check} y", f"x ghp_{body}{check[::-1]}0 y"
    assert [k for _, _, k in secrets.scan(good, find)] == ["forge"]
    assert secrets.scan(bad, find) == []
    assert [k for _, _, k in secrets.scan("eyJhbGciOiJub25lIn0.eyJhIjoxfQ.c2ln", find)] == ["jwt"]
    assert secrets.scan("eyJhbGciOiJub25lIn0.eyJhbGciOiJ.c2ln", find) == []
    # code points, not bytes, and case folding that changes lengths
    assert secrets.scan("\u0130 TOKEN=" + "b" * 12, find)[0] == (2, 20, "assign")


def _tiktoken():
    ranks = {t: k for k, t in enumerate(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark, small, edge, empty, pairs):
    path, docs, rows = small
    theirs, ours = _tiktoken(), bpe.public_vocabulary(spark)

    def expected(rows):
        for d, t in rows:
            ids = theirs.encode_ordinary(t or "")
            yield d, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(t or "")
    same(bpe.round_trip(docs, ours), expected(rows))
    same(bpe.round_trip(edge, ours), expected(pairs))
    assert bpe.round_trip(empty, ours).collect() == []
    ids = bpe.encode(edge, ours)
    same(bpe.decode(ids, ours), [(d, t or "") for d, t in pairs])


def test_bpe_long_text_in_runs(monkeypatch):
    ours = bpe.Vocabulary(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    text = "<|endoftext|> it's\n\n  caf\u00e9 " * 500 + "y" * 3000
    whole = bpe.Codec(ours).digests(text)
    monkeypatch.setattr(bpe, "LONG", 10)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    assert bpe.Codec(ours).digests(text) == whole
    assert whole[0] == len(_tiktoken().encode_ordinary(text))


def test_perfect_hash():
    for n in (1, 2, 3, 7, 500):
        keys = [f"key{k}".encode() for k in range(n)]
        found = bpe.PerfectHash(keys)
        assert sorted(found.at) == list(range(n))
        assert [found.slot(k) for k in keys] == list(range(n))


def test_simhash(small, edge, empty, pairs):
    path, docs, rows = small
    from propal.llm.queries import QUERIES
    same(QUERIES["op6_simhash"](docs.sparkSession, path), brute.simhash(rows))
    got = {(r["doc_id"], r["bits"] % 2 ** 64, r["component_id"]) for r in simhash.simhash_groups(edge).collect()}
    assert got == {(d, int(f, 16), c) for d, f, c in brute.simhash(pairs)}
    assert simhash.simhash_groups(empty).collect() == []
    kept = simhash.keep_first(edge)
    assert kept.columns == edge.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _, c in brute.simhash(pairs) if d == c or d is None}


def test_simhash_cells_lose_no_link():
    """Chains of flipped bits around one centre, with small and large cells."""
    own = random.Random(5)
    fps = [own.getrandbits(64)]
    for _ in range(400):
        x = own.choice(fps[-40:])
        for b in own.sample(range(64), own.randint(1, 4)):
            x ^= 1 << b
        fps.append(x)
    fps = np.array(sorted(set(fps)), np.uint64)
    emb = simhash.embed(fps)
    masks = [np.uint64(m % 2 ** 64) for m in simhash.cell_masks(3)]
    keys = np.concatenate([(emb & m) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k) for k, m in enumerate(masks)])
    for limit in (simhash.CELL, 8):
        simhash.CELL, before = limit, simhash.CELL
        a, b = simhash.cell_links(keys, np.tile(fps, len(masks)))
        simhash.CELL = before
        ours, true = brute.Union(len(fps)), brute.Union(len(fps))
        place = {int(f): k for k, f in enumerate(fps)}
        for x, y in zip(a.tolist(), b.tolist()):
            ours.join(place[x], place[y])
        for i in range(len(fps)):
            for j in range(i):
                if (int(fps[i]) ^ int(fps[j])).bit_count() <= 3:
                    true.join(i, j)
        n = range(len(fps))
        assert all((ours.find(i) == ours.find(j)) == (true.find(i) == true.find(j)) for i in n for j in n)


def test_exact(edge, empty, pairs):
    same(exact_dedup.exact_dedup(edge), brute.exact(pairs))
    assert exact_dedup.exact_dedup(empty).collect() == []
    kept = exact_dedup.keep_owners(edge)
    assert kept.columns == edge.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, k, *_ in brute.exact(pairs) if d == k or d is None}


def test_trie_spills_by_subtree():
    own = random.Random(3)
    keys = [b"p" * own.randint(0, 300) + bytes(own.choices(b"ab", k=own.randint(0, 6))) for _ in range(600)]
    trie = exact_dedup.SpillingTrie(lambda a, b: (max(a[0], b[0]), a[1] + b[1]), budget=4000)
    expected = {}
    for k, key in enumerate(keys):
        trie.add(key, (k, 1))
        expected[key] = (k, expected.get(key, (0, 0))[1] + 1)
    assert trie.spilled
    assert sorted(trie.items()) == sorted(expected.items())


def test_cut_repeats(small, edge, empty, pairs):
    path, docs, rows = small
    same(substring_dedup.cut_repeats(docs), brute.cut(rows))
    short = [(d, t) for d, t in pairs if len(t or "") < 100_000]
    same(substring_dedup.cut_repeats(edge.where("doc_id IS NULL OR doc_id <> 10")), brute.cut(short))
    assert substring_dedup.cut_repeats(empty).collect() == []


def test_cut_repeats_over_pieces(spark, monkeypatch):
    """Documents over several hash pieces and batches; few letters, so that anchors tie."""
    own = random.Random(9)
    monkeypatch.setattr(substring_dedup, "PIECE", 400)
    monkeypatch.setattr(substring_dedup, "BATCH", 3000)
    part = "".join(own.choices("ab", k=500))
    rows = [(k, "".join(own.choices("ab", k=own.randint(0, 900))) + part[own.randint(0, 300):][:own.randint(0, 300)]
             + "ab" * own.randint(0, 60)) for k in range(40)]
    batches = [substring_dedup.Batch([d for d, _ in rows], [len(t) for _, t in rows], b"", 0)]
    batches[0].data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    for base in (substring_dedup.BASES[0],):
        spans = [(s, c) for _, _, strings in substring_dedup.anchors(batches[0].data, batches[0].ends)
                 for s, c in zip(*strings(slice(None)))]
        covered = sorted(x for s, c in spans for x in range(s, s + c))
    ends = batches[0].ends
    every = [i for k, e in enumerate(ends) for i in range(ends[k - 1] if k else 0, e - 49)]
    assert sorted(set(covered)) == every          # each string has an anchor
    same(substring_dedup.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")), brute.cut(rows))


def test_index_family_levels():
    own = np.random.default_rng(4)
    store = own.integers(0, 2, 4000).astype(np.uint8)
    family, first = substring_dedup.IndexFamily(store), {}
    sums = substring_dedup.prefix_sums(store, substring_dedup.BASES[1])
    parts = []
    for _ in range(20):
        at = np.unique(own.integers(0, 3900, 100))
        doc = own.integers(0, 1000, len(at))
        p = substring_dedup.prints(sums, at, at + 50, substring_dedup.BASES[1])
        family.add(p, doc, at)
        parts.append((p, at))
        for a, d in zip(at, doc):
            w = store[a:a + 50].tobytes()
            first[w] = min(first.get(w, 10 ** 9), d)
    sizes = [len(x[0]) for x in family.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
    for p, at in parts:
        assert family.owners(p, at).tolist() == [first[store[a:a + 50].tobytes()] for a in at]


def test_language_id(small, edge, empty):
    path, docs, rows = small
    got = {r["doc_id"]: r for r in langid.predict_languages(docs).collect()}
    true = {r["doc_id"]: r["lang"] for r in docs.collect()}
    import zlib
    assert len(got) == len(true)
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    held = [d for d, r in got.items() if r["held_out"]]
    assert sum(got[d]["lang_pred"] == true[d] for d in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    rows = langid.predict_languages(edge).collect()
    assert len(rows) == edge.count()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 7)} == {"und"}
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (4, 5, 12)} <= {"en", "fr"}
    assert langid.predict_languages(empty).collect() == []


def test_kneser_ney_sums_to_one():
    texts = ["the cat sat on the mat", "a dog and a cat", "la la la"]
    keys, n = np.unique(np.concatenate([langid.grams(langid.symbols(t)) for t in texts]), return_counts=True)
    model = langid.KneserNey(keys, n)
    for context in (keys[0] >> 6, keys[-1] >> 6, 12345):
        codes = (np.uint32(context) << np.uint32(6)) + np.arange(64, dtype=np.uint32)
        assert abs(model.probability(codes).sum() - 1) < 1e-9
