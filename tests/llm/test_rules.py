from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from odd import odd_rows
from pyspark.sql import functions as F

from pactlake.llm import rules
from pactlake.llm.rules import js_distance, judge, references

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered)


def made(seed, n=60):
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = [rng.choice("ab") if i % 3 == 0 else rng.choice(["the", "of", "and"] + ["".join(rng.choice("abcdefghé") for _ in range(5)) for _ in range(6)]) for _ in range(rng.choice((0, 2, 30, 150)))]
        text = "".join(w + rng.choice([" ", "  ", "\n", "\t", " #", "\x0b"]) for w in words)
        rows.append((i, text + ("\nsame line\nsame line" if i % 4 == 0 else ""), rng.choice(["en", "xx"]), "a"))
    return rows


def test_base_figures_equal_brute_force(documents):
    rows = made(1) + [(100, "a b c a b c a b", "en", "a"), (101, "a a a a", "en", "a"), (102, "a\nb\na\n\n \n \n", "en", "a")]
    for r in judge(documents(rows)).collect():
        n, chars, symbols, lines, repeated = brute_base(next(t for d, t, *_ in rows if d == r["doc_id"]))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, repeated)
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
        assert not (r["kept"] and r["base_failed"])


def brute_js(p, q):
    return math.sqrt(max(0, sum((a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0) for a, b in zip(p, q, strict=True)) / 2))


def test_distance(spark):
    for p, q in (([1.0, 0.0], [0.0, 1.0]), ([0.5, 0.5], [0.5, 0.5]), ([0.7, 0.2, 0.1], [0.1, 0.1, 0.8])):
        found = spark.range(1).select(js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q)))).first()[0]
        assert found == pytest.approx(brute_js(p, q), abs=1e-9)


def test_word_distances_equal_brute_force(documents):
    rows = made(3)
    reference = {}
    for lang in ("en", "xx"):
        counts = Counter(w.lower() for _, t, g, _ in rows if g == lang for w in WORD.findall(t))
        whole = sum(counts.values())
        top = sorted((w for w in counts if counts[w] >= whole * rules.LEAST_SHARE), key=lambda w: (-counts[w], w))[: rules.COMMON]
        reference[lang] = (top, [counts[w] / whole for w in top])
    for r in references(documents(rows)).collect():
        top, shares = reference[r["language"]]
        assert r["common"] == top and r["shares"][:-1] == pytest.approx(shares) and sum(r["classes"]) == pytest.approx(1)
    texts = {d: (t, g) for d, t, g, _ in rows}
    for r in judge(documents(rows)).collect():
        text, lang = texts[r["doc_id"]]
        top, shares = reference[lang]
        counts = Counter(w.lower() for w in WORD.findall(text))
        n = max(1, sum(counts.values()))
        mine = [counts[w] / n for w in top]
        mine.append((sum(counts.values()) - sum(counts[w] for w in top)) / n)
        assert r["word_distance"] == pytest.approx(brute_js(mine, [*shares, max(0, 1 - sum(shares))]), abs=1e-6)


def test_only_words_in_a_common_words_place_are_looked_up(documents, monkeypatch):
    """All words are looked up if there is one place, few others than the common ones if there are many; the distances are the same."""
    rows = made(6)
    looked, distances = {}, {}
    for slots in (1, 1024):
        monkeypatch.setattr(rules, "SLOTS", slots)
        table = documents(rows)
        reference = rules.with_slots(references(table)).withColumnRenamed("language", "lang")
        said = table.select("doc_id", "lang", rules.words(F.col("text")).alias("said")).join(reference, "lang")
        found = said.select(F.explode(rules.common_words(F.col("said"), F.col("common"), F.col("slots"))).alias("kind"))
        looked[slots] = {r["kind"]: r["count"] for r in found.groupBy("kind").count().collect()}
        distances[slots] = {r["doc_id"]: r["word_distance"] for r in judge(table).collect()}
    others = [counts.pop(0, 0) for counts in looked.values()]
    assert looked[1] == looked[1024] and others[1] < others[0] / 4
    assert distances[1] == distances[1024]


def test_no_character_is_of_two_classes():
    classes = [re.compile(p) for p in (r"[\x20\x09-\x0D]", r"[.,;:!?]", rules.SYMBOLS)]
    assert tuple(rules.CLASSES[3:]) == tuple(c.pattern for c in classes)
    assert all(sum(bool(c.match(chr(i))) for c in classes) + chr(i).isalnum() <= 1 for i in range(0x3000))


def test_short_texts_are_guarded_and_strange_ones_go(documents):
    rng = random.Random(4)
    plain = lambda n: " ".join(rng.choice(["the", "of", "and", "to", "oak", "elm", "ash", "yew", "fir"]) + rng.choice(["", "", ",", "."]) for _ in range(n))
    rows = [(i, plain(300), "en", "a") for i in range(40)] + [(100, " ".join(f"{i}@@{i}~~" for i in range(200)), "en", "a"), (101, " ".join(f"{i}@@~~" for i in range(60)), "en", "a")]
    found = {r["doc_id"]: r for r in judge(documents(rows)).collect()}
    base = [r for d, r in found.items() if d < 100 and not r["base_failed"]]
    assert all(r["kept"] for r in base)
    assert not found[100]["base_failed"] and not found[100]["kept"]
    assert found[101]["kept"]


def test_odd_rows(documents):
    found = judge(documents(odd_rows())).collect()
    assert len(found) == 9
    assert all((r["n_words"], r["kept"], r["base_failed"]) == (0, False, True) for r in found if r["doc_id"] in (1, 2, 3))
    assert {r["n_words"] for r in found if r["doc_id"] == 7} == {60_000}
    assert judge(documents([])).count() == 0


def test_no_python_runs(documents):
    plan = judge(documents(made(5, 4)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
