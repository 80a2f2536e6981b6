"""Operators without a contract, and the pipeline."""

import random
import re

import corpus_pipeline
import numpy as np
from propal.llm import decontaminate, langid, line_dedup, quality, surrogates
from pyspark.sql import functions as F
from tests.llm import brute
from tests.llm.conftest import words


def test_surrogates_keep_format_and_agree():
    keyed = surrogates.Keyed()
    text = ("Mail Ann.B09@mail1.example.com or ann.b09@mail1.example.com, +1 (968) 555-9369 or 968-555-9369, 39.197.112.39, "
            "4467920212765298 4467 9202 1276 5298, Mrs. Anna Smith met Herr Peter M\u00fcller, DE89 3704 0044 0532 0130 00, "
            "123-45-6789")
    new, kinds = surrogates.replace(text, keyed, {})
    assert kinds == ["email", "email", "phone", "phone", "ipv4", "card", "card", "name", "name", "iban", "ssn"]
    found, after = surrogates.find(text), surrogates.find(new)
    assert [f[2] for f in after] == kinds                       # surrogates are of the same kind, check digits included
    assert after[0][3] == after[1][3] and after[5][3] == after[6][3]
    assert after[2][3].split("|")[1] == after[3][3]
    assert all(a[3] != b[3] for a, b in zip(found, after))
    shape = lambda s: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", s)))
    card, mail = new[after[6][0]:after[6][1]], new[after[0][0]:after[0][1]]
    assert shape(card) == "0000 0000 0000 0000" and shape(mail) == shape("Ann.B09@mail1.example.com")
    given = re.search(r"Mrs\. (\w+)", new).group(1).lower()
    assert given in surrogates.GIVEN[0]
    assert re.search(r"Herr (\w+)", new).group(1).lower() in surrogates.GIVEN[1]
    assert all(c in surrogates.ALPHABETS[4] for c in keyed.surrogate("name", "f:\u0430\u043d\u043d\u0430 \u0438\u0432", 0)[-2:])


def test_surrogates_of_names_without_titles():
    """All mentions of a name in its document, under any title or none, agree."""
    text = ("Mrs. Anna Smith came. Anna Smith said that Dr. Anna Smith's car is Smith's; Anna left. "
            "In Will and Smithson nobody is named.")
    found = surrogates.find(text)
    assert [text[s:e] for s, e, *_ in found] == ["Anna Smith"] * 3 + ["Smith", "Anna"]
    assert {f[2:] for f in found} == {("name", "anna smith")}
    new, _ = surrogates.replace(text, surrogates.Keyed(), {})
    first, last = re.match(r"Mrs\. (\w+) (\w+) came", new).groups()
    assert new == text.replace("Anna", first).replace("Smith", last).replace(f"{last}son", "Smithson")
    assert first.lower() in surrogates.GIVEN[0] and (first, last) != ("Anna", "Smith")


def test_surrogates_across_titles(spark):
    """One entity under two titles is no collision."""
    docs = spark.createDataFrame([(1, "Mrs. Anna Smith"), (2, "Dr. Anna Smith"), (3, "Prof. Anna Smith")],
                                 "doc_id long, text string")
    assert surrogates.redrawn(surrogates.mentions(docs)).count() == 0
    assert len({r["text"].split(" ", 1)[1] for r in surrogates.with_surrogates(docs).collect()}) == 1


def test_surrogates_of_phone_groups():
    numbers = ["+44 20 7946 0958", "01 23 45 67 89", "+49 30 1234567", "+34 912 345 678", "912 345 678", "+49 (30) 1234567",
               "020 7946 0958", "+442079460958", "+1 (968) 555-9369", "968-555-9369"]
    keyed = surrogates.Keyed()
    for number in numbers:
        text = f"call {number}, or write"
        assert [f[:3] for f in surrogates.find(text)] == [(5, 5 + len(number), "phone")], number
        new, _ = surrogates.replace(text, keyed, {})
        assert new != text and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", text)
        assert [f[2] for f in surrogates.find(new)] == ["phone"], new
    assert surrogates.find("+44 20 7946 0958")[0][3] == surrogates.find("+442079460958")[0][3]
    for other in ("on 01-02-2023 or 01.02.2023", "007 12", "2023-01-02 03:04:05", "0.25 and 06 70"):
        assert surrogates.find(other) == [], other


def test_permutations():
    keyed = surrogates.Keyed()
    for n in (2, 10, 777):
        assert sorted(keyed.number(k, n, "t") for k in range(n)) == list(range(n))
    assert surrogates.Keyed(b"other").number(5, 10 ** 9, "t") != keyed.number(5, 10 ** 9, "t")


def test_permutations_leave_nothing_in_place():
    keyed = surrogates.Keyed()
    for n in (2, 3, 10, 105):
        moved = [keyed.number(k, n, "t") for k in range(n)]
        assert sorted(moved) == list(range(n)) and all(a != b for a, b in enumerate(moved))


def test_every_name_of_a_format(spark):
    """Names that fill their format (unlisted given names with all surnames of
    the shape of Li) need no second draw."""
    given = [f"{a}{b}{c}" for a in "vz" for b in "aeiou" for c in "bcdfghjklm"] + ["Anna", "Maria", "Paul"]
    last = [f"{a}{b}" for a in surrogates.CONSONANTS for b in surrogates.VOWELS]
    rows = [(k, " ".join(f"Mr. {g.capitalize()} {n.capitalize()}," for n in last)) for k, g in enumerate(given)]
    found = surrogates.mentions(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.count() == len(given) * len(last) > 13 * 105
    keyed = surrogates.Keyed()
    assert len({keyed.surrogate("name", r["entity"], 0) for r in found.collect()}) == found.count()
    assert surrogates.redrawn(found).isEmpty()


def test_surrogates_stay_apart(spark, monkeypatch):
    """A surrogate that clashes is drawn anew, on both ways."""
    plain = surrogates.Keyed._surrogate
    monkeypatch.setattr(surrogates.Keyed, "_surrogate",
                        lambda self, kind, entity, turn: "1.2.3.4" if not turn else plain(self, kind, entity, turn))
    rows = [(k, f"see 10.0.0.{k % 40} here") for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = surrogates.mentions(docs).select("kind", "entity").distinct()
    keyed = surrogates.Keyed()
    drawn = [keyed.surrogate("ipv4", r["entity"], 0) for r in found.collect()]
    assert len(set(drawn)) == 1
    for most in (surrogates.REDRAWN, -1):
        out = {r["doc_id"]: r["text"] for r in surrogates.with_surrogates(docs, most_redrawn=most).collect()}
        assert len(out) == 80 and len(set(out.values())) == 40
        assert all(out[k] == out[k + 40] for k in range(40))


def test_surrogates_edge(edge, empty, pairs):
    out = surrogates.with_surrogates(edge).collect()
    assert sorted(map(repr, (r["doc_id"] for r in out))) == sorted(repr(d) for d, _ in pairs)
    assert {r["text"] for r in out if r["doc_id"] in (1, 2, 7)} == {""}
    assert surrogates.with_surrogates(empty).collect() == []


def test_lines(small, edge, empty, pairs):
    path, docs, rows = small
    for frame, expected in ((docs, brute.lines(rows)), (edge, brute.lines([p for p in pairs if p[0] != 10]))):
        for r in line_dedup.line_dedup(frame).collect():
            if r["doc_id"] != 10 and r["doc_id"] is not None:
                assert (r["n_lines"], list(r["removed"])) == expected[r["doc_id"]]
    assert line_dedup.line_dedup(empty).collect() == []
    text = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(edge).collect()}
    assert text[17] == "one\ntwo" and text[1] == "" and text[3] == " \n\t \n"


def test_fuzzy_lines(spark):
    line = words(7, 300)
    other = line.replace(line.split()[5], "qqq", 1)
    rows = [(2, f"x {words(8, 5)}\n{other}"), (1, f"{line}\n{words(9, 20)}"), (3, f"{words(9, 20).upper()}!!")]
    got = {r["doc_id"]: list(r["removed"]) for r in
           line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: gone for d, (_, gone) in brute.lines(rows).items()}
    assert got[3] == [0]


def test_alike_lines(spark):
    """Pieces of a pair decide like the whole: around the limit, with text moved, short, empty and beyond ASCII."""
    rng = random.Random(4)
    pairs = [("", ""), ("", "a"), ("a", "b"), ("aaaaa", "aaaab"), ("aaaa", "aaab"), ("é" * 40, "é" * 33), ("ab" * 60, "ba" * 60)]
    for n in (3, 17, 60, 200):
        for share in (0.02, 0.1, 0.18, 0.2, 0.22, 0.3):
            chars = [rng.choice("abcdeé ") for _ in range(n)]
            other = list(chars)
            for _ in range(int(n * share + rng.random())):
                k = rng.randrange(len(other))
                other[k:k + 1] = rng.choice(([], [rng.choice("abc")], [other[k], "ß"]))
            pairs += [("".join(chars), "".join(other)), ("".join(chars[9:] + chars[:9]), "".join(chars))]
    frame = spark.createDataFrame(pairs, "a string, b string")
    got = [r for r in frame.select("a", "b", F.expr(line_dedup.alike("a", "b")).alias("same")).collect()]
    assert len(got) == len(pairs) and {True, False} == {r["same"] for r in got}
    for r in got:
        longer = max(len(r["a"]), len(r["b"]))
        assert r["same"] == (brute.edits(r["a"], r["b"]) <= int(longer * 0.2 + 1e-9)), r


def benchmark(spark):
    items = [(1, words(100, 30)), (2, words(101, 14)), (3, None), (4, ""), (5, "abc"), (6, words(102, 60)), (6, words(102, 60))]
    return spark.createDataFrame(items, "item_id long, text string"), dict(items)


def test_decontamination(spark):
    bench, items = benchmark(spark)
    own = items[1]
    edited = own[:40] + "#!" + own[41:90] + own[92:]
    rows = [(1, f"{words(1, 50)} {own} {words(2, 50)}"), (2, f"{words(3, 20)}\n{edited.upper()}\n{words(4, 20)}"),
            (3, words(5, 3000)), (4, None), (5, ""), (6, items[2]), (7, items[6][60:260]), (8, own[:50] + words(6, 60)),
            (None, items[6]), (9, "abc"), (10, f"{own} {items[2]}"), (10, f"{own} {items[2]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id")
    expected = {(1, 1), (2, 1), (6, 2), (7, 6), (None, 6), (10, 1), (10, 2)}
    for chars in (decontaminate.INDEX_CHARS, 200):     # one index, and shards
        got = decontaminate.contaminated(docs, bench, chars)
        assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == expected
        kept = decontaminate.keep_clean(docs, bench, chars)
        assert sorted((r["doc_id"] for r in kept.collect())) == [3, 4, 5, 8, 9]


def test_decontamination_lemma():
    """The filter keeps every window that brute force finds within the budget."""
    import random
    own = random.Random(2)
    item = words(50, 40)
    index = decontaminate.Index([(1, item)])
    for trial in range(60):
        text = list(item)
        for _ in range(own.randint(0, 14)):
            k = own.randrange(len(text))
            text[k:k + 1] = own.choice(([], ["q"], [text[k], "z"]))
        whole = decontaminate.normalised(words(trial, 10) + " " + "".join(text) + " " + words(trial, 9))
        found = {w for w, *_ in index.matches(whole)}
        for w, window in enumerate(index.windows):
            row = [0] * (len(whole) + 1)
            for i, x in enumerate(window.tolist(), 1):
                new = [i]
                for j, y in enumerate(whole.tolist(), 1):
                    new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
                row = new
            assert (min(row) <= index.edits[w]) == (w in found)
        if trial > 12:
            break


def test_decontamination_passages():
    """Every passage of 13 words is found, wherever it lies in its item; in
    scripts without spaces, 26 characters.  Eight words are none."""
    item = words(60, 60)
    split = item.split()
    han = "".join(chr(0x4E00 + k * 7919 % 20000) for k in range(120))
    index = decontaminate.Index([(1, item), (2, han)])

    def found(passage):
        return [f[0] for f in decontaminate._found(index, [words(61, 30), f"{words(62, 30)} {passage} {words(63, 30)}"])[1]]
    for k in range(len(split) - 12):
        assert found(" ".join(split[k:k + 13])) == [1]
        assert found(" ".join(split[k:k + 8])) == []
    for k in range(len(han) - 25):
        assert found(han[k:k + 26]) == [2]
    long = "".join(f"{k * 7919 % 10007:04x}" for k in range(200))
    index = decontaminate.Index([(3, long)])
    assert found(long[333:333 + 112]) == [3]


def test_decontamination_edge(edge, empty, spark):
    bench, _ = benchmark(spark)
    assert decontaminate.contaminated(edge, bench).count() == 0
    assert decontaminate.keep_clean(edge, bench).count() == edge.count()
    assert decontaminate.contaminated(empty, bench).count() == 0
    none = bench.where("false")
    assert decontaminate.contaminated(edge, none).count() == 0
    assert decontaminate.keep_clean(edge, none).columns == edge.columns


def test_decontamination_given(small, spark):
    path, docs, rows = small
    bench = spark.read.parquet(f"{path}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    exact = {(d, i) for d, t in rows for i, b in items if b in t}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert exact and got == exact


def test_language_id_scripts(spark):
    """Languages of one script other than Latin are told apart, and scripts too."""
    import random

    def text(seed, alphabet, often):
        own = random.Random(seed)
        said = ["".join(own.choices(alphabet, weights=[9 if c in often else 1 for c in alphabet], k=4)) for _ in range(60)]
        return " ".join(said)
    cyrillic, greek, arabic = "\u0430\u0431\u0432\u0433\u0434\u0435\u0436\u0437", "\u03b1\u03b2\u03b3\u03b4", "\u0627\u0628\u062a\u062b"
    kinds = {"ru": (cyrillic, cyrillic[:3]), "uk": (cyrillic, cyrillic[4:7]), "el": (greek, greek[:2]), "gx": (greek, greek[2:]),
             "ar": (arabic, arabic[:2]), "fa": (arabic, arabic[2:]), "zh": ("\u4e00\u4e01\u4e02\u4e03", "\u4e00\u4e01"),
             "ja": ("\u4e00\u4e01\u4e02\u4e03", "\u4e02\u4e03"), "pl": ("\u0105\u0119\u0142\u0144", "\u0105\u0119"),
             "cs": ("\u0105\u0119\u0142\u0144", "\u0142\u0144"), "wide": ("\U00020000\U00020001", "\U00020000"),
             "wider": ("\U00020000\U00020001", "\U00020001")}
    rows = [(k * 100 + n, lang, text(k * 100 + n, *kind)) for k, (lang, kind) in enumerate(kinds.items()) for n in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict_languages(docs).collect() if r["held_out"]}
    wrong = [(lang, got[d]) for d, lang, _ in rows if d in got and got[d] != lang]
    assert len(got) > 50 and wrong == []


def test_language_of_calibration_texts(spark):
    """A language that only remainder 3 has is learnt too."""
    import zlib
    texts = {True: "zzz qqq zqz qzq " * 6, False: "abba cada bab dac " * 6}
    rows = []
    for d in range(120):
        part = zlib.crc32(str(d).encode()) % 4
        rare = d % 2 == 0 if part == 2 else part == 3
        rows.append((d, "rare" if rare else "often", texts[rare]))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict_languages(docs).collect()}
    assert got == {d: lang for d, lang, _ in rows}


def test_language_symbols():
    assert langid.units("A1\U00020001 \u0416").tolist() == [0, ord("a"), 0, 0xD840, 0xDC01, 0, 0x436, 0]
    keys = langid.grams(langid.units("\u0436\u0430\u0431\u0430 abc " * 3))
    counts = {lang: np.unique(k, return_counts=True) for lang, k in (("x", keys), ("y", keys[:5]))}
    models = langid.Languages(counts)
    place, seen = models.places(np.r_[models.keys, keys + np.uint64(7 << 40)])
    assert seen.tolist() == [True] * len(models.keys) + [k in set(models.keys) for k in keys + np.uint64(7 << 40)]
    assert place[:len(models.keys)].tolist() == list(range(len(models.keys)))


def test_quality(spark):
    """Trained on half of the labels, right on the other half."""
    from tests.conftest import SF_CHECK
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    known = labels.where("doc_id % 2 = 0")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_scores(docs, known).collect()}
    held = [(r["doc_id"], bool(r["quality"])) for r in labels.where("doc_id % 2 = 1").collect()]
    assert len(kept) == docs.count()
    assert sum(kept[d] == q for d, q in held) >= 0.97 * len(held)


def test_quality_edge(edge, empty, spark):
    none = spark.createDataFrame([(None, 1, None), (4, None, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(edge, none).collect()
    assert len(rows) == edge.count() and all(r["kept"] and r["p_good"] == 1.0 for r in rows)
    assert quality.quality_scores(empty, none).collect() == []
    assert quality.keep_good(edge, none).columns == edge.columns


def test_quality_fit_on_edge_rows(edge, spark):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(1, 18)] + [(3, None, None)], "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(edge, labels).collect()
    assert len(rows) == edge.count() and all(0 <= r["p_good"] <= 1 for r in rows)


def test_stages_keep_columns(edge, small):
    path, docs, _ = small
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(edge.sparkSession, edge, path)
        assert out.columns == edge.columns, name
    assert corpus_pipeline.STAGES[-1][1](edge.sparkSession, edge, path).count() == edge.count()


def test_pipeline_equals_brute_force(spark, small):
    """After the quality stage, whose classifier has its own test, the stages
    give what brute force gives."""
    path, docs, rows = small
    by_stage = dict(corpus_pipeline.STAGES)
    good = [(r["doc_id"], r["text"]) for r in by_stage["quality classifier"](spark, docs, path).collect()]
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    assert {d for d, _ in good} >= {d for d, q in truth.items() if q}
    left = [(d, t) for (d, t), e in zip(good, brute.exact(good)) if e[3]]
    left = [(d, t) for (d, t), e in zip(left, brute.simhash(left)) if d == e[2]]
    items = [r["text"] for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    left = [(d, t) for d, t in left if not any(i in t for i in items)]
    got = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.run(spark, path).collect()}
    assert got == {d: brute.sha(t) for d, t in left}
