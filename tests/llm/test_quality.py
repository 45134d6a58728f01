import re
from collections import Counter

import pytest

from sluice.llm import queries, quality
from tests.llm.conftest import edge_rows, words


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_edges_match_brute_force(edge, empty):
    q = quality.judge(edge).select("text", "__quality.*").collect()
    assert len(q) == len(edge_rows())
    for r in q:
        c = r["counts"]
        got = (c["n_words"], c["word_chars"], c["n_symbols"], c["n_dup_lines"], c["n_repeat_words"])
        assert got == brute(r["text"])
        assert r["base_failed"] == (got[0] < 50 or 100 * got[4] > 50 * got[0])
        assert not (r["kept"] and r["base_failed"])
    assert quality.judge(empty).collect() == []


def test_repeats(spark):
    texts = ["a b c a b c", "a b c a b", "a a a a a", "a b c d", "a b c", "a", "", "x\ny\nx\n \nx", "the the the the", words(300, 2) + " " + words(300, 2)]
    got = quality.judge(spark.createDataFrame([(t,) for t in texts], "text string")).select("text", "__quality.counts.*").collect()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(r["text"])


@pytest.mark.parametrize("rule", quality.RULES)
def test_each_rule_decides(spark, rule):
    good = "the cat and the dog of a house is on it " * 1 + " ".join(f"word{i} and the" for i in range(40))
    bad = {"mean_word_length": "the " * 0 + " ".join(f"the{'x' * 20}{i} and" for i in range(50)), "symbol_ratio": good + " # # # # # # # # # # # # # # # # # #",
           "stop_word_ratio": " ".join(f"zork{i}" for i in range(80)), "duplicate_line_ratio": good + "\nthe end\nthe end\nthe end\nthe end"}[rule.name]
    rows = quality.judge(spark.createDataFrame([(good,), (bad,)], "text string")).select("__quality.*").collect()
    assert rows[0]["kept"] and rows[0]["broken"] == []
    assert not rows[1]["kept"] and rule.name in rows[1]["broken"]


def test_no_python_in_the_plan(spark, tables):
    plan = queries.op4_quality_rules(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
