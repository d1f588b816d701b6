"""Collocations against plain counting, on edge cases, small chunks and repeated passages; paths of the graph."""

import os
import random
import re
import sys
from collections import Counter, defaultdict

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import plain  # noqa: E402

from tallygrid.llm import phrases  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, id int, n string, words int"


def counted(rows):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(plain.LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return f, n


def plain_phrases(rows, least=30, top=2000):
    f, n = counted(rows)
    out = []
    for lang in f:
        good = {g: a for g, a in f[lang].items() if len(g) > 1 and a >= least}
        drop = {g[i:i + k] for g, a in good.items() for k in range(2, len(g)) for i in range(len(g) - k + 1)
                if 100 * a >= 80 * f[lang][g[i:i + k]]}
        scored = []
        for g, a in good.items():
            if g not in drop:
                cut = min((2_000_000 * a // (f[lang][g[:k]] + f[lang][g[k:]]), k) for k in range(1, len(g)))
                scored.append((-cut[0], -a, " ".join(g).encode(), f[lang][g[:cut[1]]], f[lang][g[cut[1]:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def special(seed=2):
    rng = random.Random(seed)
    words = "the of and a in new york city alpha beta gamma it's Größe 漢字 é 🙂".split()
    rows = []
    for k in range(700):
        text = " ".join(rng.choice(words[:6] if rng.random() < 0.6 else words) for _ in range(rng.randrange(0, 25)))
        text += rng.choice(["", ". ", "\n", ";\t"]) + rng.choice(["New York City hall is open", "a a a a a a", "", "x y", "one rare%d two" % k, "ab cd ef"])
        rows.append((text, rng.choice(["en", "de", None, "und"])))
    passage = " ".join(f"w{i}" for i in range(80))
    return rows + [(passage, "fr")] * 40 + [("intro " + passage + ". " + passage, "fr")] * 3 + [
        (None, None), (None, "en"), ("", ""), (" \t\n", "x y"), ("only", "zz"), ("..!!", "zz"), ("loop " * 5000, "zz"), ("\x00 \x01 \x0b" * 40, "zz")]


def frame(spark, rows):
    return spark.createDataFrame([(i % 50, t, g, 1, "x", 2) for i, (t, g) in enumerate(rows)], SCHEMA).repartition(5)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 3_000, "bucket_bytes": 9_000}])
def test_plain(spark, sizes):
    assert found(phrases.collocations(frame(spark, special()), **sizes)) == plain_phrases(special())


def test_top_and_ties(spark):
    rows = special()
    assert found(phrases.collocations(frame(spark, rows), least=5, top=7)) == plain_phrases(rows, 5, 7)


def test_empty(spark):
    assert found(phrases.collocations(frame(spark, special()).where("false"))) == []
    assert found(phrases.collocations(frame(spark, [(None, None), ("", "en")]))) == []


def test_counts_follow_from_flow(spark):
    """Every gram's count is the sum of the edges that leave its node and of the pieces that end there."""
    rows = special()
    grams, words, totals = phrases.graph(frame(spark, rows), chunk_bytes=4_000, bucket_bytes=20_000)
    f, n = counted(rows)
    spelled = {r["id"]: (r["lang"], r["word"]) for r in words.collect()}
    got = {(spelled[r["words"][0]][0], tuple(spelled[i][1] for i in r["words"])): r["n"] for r in grams.collect()}
    assert got == {(lang, g): a for lang in f for g, a in f[lang].items() if len(g) > 1 and a >= 30}
    assert {r["lang"]: r["n"] for r in totals.collect()} == {lang: c for lang, c in n.items() if c}


def test_paths(spark):
    """Paths hold every edge once, run through nodes with one way in and one out only, and open cycles."""
    edges = {(i, i + 1, i + 2, i + 3): 50 + i for i in range(1, 40)}
    edges |= {(5, 6, 7, 90): 31, (6, 7, 90, 91): 31}
    edges |= {(200 + i % 7, 200 + (i + 1) % 7, 200 + (i + 2) % 7, 200 + (i + 3) % 7): 33 for i in range(7)} | {(9, 9, 9, 9): 44}
    df = spark.createDataFrame([(list(k), v) for k, v in edges.items()] + [([1, 2], 99), ([1, 2, 3], 98)], "words array<bigint>, n bigint")
    for cut in (4096, 5):
        rows = phrases.paths(df, cut).collect()
        walked = Counter((tuple(r["words"][i:i + 4]), r["counts"][i]) for r in rows for i in range(len(r["counts"])))
        assert walked == Counter(edges.items()) and all(len(r["words"]) == len(r["counts"]) + 3 for r in rows)
    lengths = sorted(len(r["counts"]) for r in phrases.paths(df).collect())
    assert lengths == sorted([1, 7, 2, 4, 35])
