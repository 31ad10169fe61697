import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from pricewright.llm.language_id import PROFILE, collected, grams, held_out_identification, known_languages, language_profiles, predict

LETTERS = {"aa": "abcde", "bb": "defgh", "cc": "ijäöü"}


def brute_grams(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    found = Counter(c for w in words for c in w)
    for w in words:
        edged = f" {w} "
        found.update(edged[i : i + 2] for i in range(len(edged) - 1))
        found.update(edged[i : i + 3] for i in range(len(edged) - 2))
    return found


def decoded(keys):
    out = []
    for k in keys.tolist():
        chars = []
        while k:
            chars.append(chr(k & 0x1FFFFF))
            k >>= 21
        out.append("".join(reversed(chars)))
    return out


def brute_predict(text, profiles):
    found = brute_grams(text)
    if not found or not profiles:
        return "und"
    place = {g: sum(m > n for m in found.values()) for g, n in found.items()}
    top = {g: p for g, p in place.items() if p < PROFILE}
    away = {lang: sum(min(abs(known[g] - p), PROFILE) if g in known else PROFILE for g, p in top.items()) for lang, known in profiles.items()}
    return min(sorted(away), key=away.get)


def test_grams():
    for text in ("Hällo wörld, it's 1 a", "a", "", None, "12 ?!", "x" * 2000, "ßẞ İ", "  two  words "):
        keys, counts = grams(text)
        assert dict(zip(decoded(keys), counts.tolist())) == dict(brute_grams(text)), text


def corpus():
    draw = random.Random(2)
    rows = []
    for i in range(90):
        lang = draw.choice(list(LETTERS))
        text = " ".join("".join(draw.choice(LETTERS[lang]) for _ in range(draw.randint(1, 7))) for _ in range(draw.randint(1, 60)))
        rows.append((i, text, lang, "s"))
    return rows


def test_equals_brute_force(spark):
    rows = corpus() + [(500, None, "aa", "s"), (501, "123 !", "aa", "s"), (502, "abc", None, "s"), (None, "ded", "bb", "s"), (3, "ij", "cc", "s"), (3, "ij", "cc", "s"), (504, "abc " * 40_000, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1
    counts = {}
    for i, text, lang, _ in rows:
        if lang and not held(i):
            counts.setdefault(lang, Counter()).update(brute_grams(text))
    key = lambda g: sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))
    profiles = {lang: {g: p for p, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], key(x[0])))[:PROFILE])} for lang, c in counts.items()}
    got = held_out_identification(docs).collect()
    assert sorted(((r.doc_id, r.held_out, r.lang_pred) for r in got), key=repr) == sorted(((i, held(i), brute_predict(t, profiles)) for i, t, _, _ in rows), key=repr)
    assert all(0 <= r.score <= 1 for r in got)
    kept = known_languages(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 2


def test_counts_in_parts_are_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, score string")
    whole = sorted(map(tuple, language_profiles(docs, F.lit(True)).collect()))
    monkeypatch.setattr("pricewright.llm.language_id.FLUSH", 50)
    assert sorted(map(tuple, language_profiles(docs, F.lit(True)).collect())) == whole


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in held_out_identification(docs).collect()] == [("und", 0.0)]
    assert held_out_identification(docs.limit(0)).collect() == []
    assert predict("abc", collected(language_profiles(docs, F.lit(True)))) == ("und", 0.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = held_out_identification(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98


def test_texts_in_an_unlearned_script_are_not_kept(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, "собака и кошка", None), (4, "cat собака", None), (5, "12 34", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in known_languages(docs).collect()) == [1, 2, 4]


def test_tasks_keep_the_first_n_grams_only(spark):
    docs = spark.createDataFrame([(1, "some text", "en")], "doc_id long, text string, lang string")
    plan = language_profiles(docs, F.lit(True))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
