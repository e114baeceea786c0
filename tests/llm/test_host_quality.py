import re
from collections import Counter

import pytest

from labelloom.llm import host_quality, shared
from llm.conftest import ODD_ROWS


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {p for i, w in enumerate(windows) if count[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines), len(lines) - len(set(lines)), len(covered),
    )


def test_odd_input(odd, empty):
    got = host_quality.judge(odd)
    expected = sorted((str(r[0]), *measures(r[1])) for r in ODD_ROWS)
    assert sorted((str(r.doc_id), *(r[m] for m in host_quality.MEASURES)) for r in got.collect()) == expected
    assert host_quality.judge(empty).count() == 0
    assert host_quality.keep_good(odd).columns == odd.columns


@pytest.mark.parametrize("text", ["a b c a b c", "a a a a", "a b c d", "x x x", "a b a b a b a", "l\nl\n l\n\n\t\nl"])
def test_measures(texts, text):
    row = host_quality.judge(texts([text])).first()
    assert tuple(row[m] for m in host_quality.MEASURES) == measures(text)


@pytest.mark.parametrize("share", [shared.HOT_SHARE, 1.0])
def test_a_rule_counts_where_the_host_breaks_it_as_a_habit(spark, monkeypatch, share):
    monkeypatch.setattr(shared, "HOT_SHARE", share)
    clean = " ".join(f"word{i}" for i in range(60))
    odd = " ".join(f"wo#rd{i}" for i in range(60))
    rows = [(i, clean if i % 10 else odd, "sound") for i in range(100)]
    rows += [(100 + i, odd if i % 10 else clean, "bad") for i in range(100)]
    rows += [(200, odd, "tiny"), (201, "too short", "sound")]
    rows += [(300 + i, clean, f"other{i}") for i in range(30)]
    judged = host_quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    dropped = {r.doc_id for r in judged if not r.kept}
    assert dropped >= {101, 201} and {r.doc_id for r in judged if r.base_failed} == {201}
    assert not dropped & {0, 10, 90, 1, 100, 110} and not dropped & set(range(300, 330))
    assert dropped >= {i for i in range(100, 200) if i % 10}


def test_priors_follow_the_spread_of_hosts(spark):
    same = [(f"h{i}", 100, 10, 10, 10, 10) for i in range(20)]
    apart = [(f"h{i}", 100, 0 if i % 2 else 90, 0, 0, 0) for i in range(20)]
    kind = "host string, n_host bigint, symbols bigint, lines bigint, word_length bigint, repeats bigint"
    strong, weak = (host_quality.beta_priors(spark.createDataFrame(rows, kind))["symbols"] for rows in (same, apart))
    assert sum(strong) == host_quality.MAX_STRENGTH and sum(weak) < 2


def test_a_row_goes_by_its_own_verdict(spark):
    clean, short = " ".join(f"word{i}" for i in range(60)), "too short"
    rows = [(None, clean, "s"), (None, short, "s"), (1, clean, "s"), (1, short, "s"), (2, clean, None)]
    kept = host_quality.keep_good(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    assert sorted(map(str, kept)) == sorted(str(r) for r in kept if r.text == clean) and len(kept) == 3
