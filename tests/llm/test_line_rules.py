import re
from collections import defaultdict

import public_tokenizers  # noqa: F401
import pytest

from conftest import SMALL
from stormledger.llm import catalog, line_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, rules=line_rules.Rules()):
    """The contract and the rules, line by line in plain Python."""
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    lost = lost_lines = 0
    for line in text.split("\n"):
        own = WORD.findall(line)
        if own:
            dup += line in seen
            seen.add(line)
        low = re.sub("[A-Z]", lambda m: m[0].lower(), line)
        marks, symbols = sum(c in "|<>" for c in line), sum(c in "#*$%&|<>" for c in line)
        solid = "".join(own).encode()
        ended = any(solid[-k:][:1].decode("latin-1") in [c for c in rules.enders if ord(c) < 128] for k in (1, 2, 3) if len(solid) >= k)
        ended = ended or any(solid.endswith(c.encode()) for c in rules.enders if ord(c) >= 128)
        if (
            any(p in low for p in rules.boilerplate) or (marks >= rules.nav_marks and marks * rules.nav_words >= len(own))
            or own and symbols >= len(own) or own and len(own) < rules.short_words and not ended
        ):
            lost, lost_lines = lost + len(own), lost_lines + 1
    places = defaultdict(list)
    for k in range(len(words) - 2):
        places[tuple(words[k:k + 3])].append(k)
    repeated = {j for at in places.values() if len(at) > 1 for k in at for j in (k, k + 1, k + 2)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), failed,
            not failed and 100 * lost <= rules.max_lost_percent * len(words), lost, lost_lines)


def rows(df):
    return sorted((r["doc_id"], *tuple(r)[1:]) for r in df.collect())


def test_odd_texts(odd):
    found = line_rules.score(odd).drop("")
    expected = sorted((r["doc_id"], *brute(r["text"])) for r in odd.collect())
    assert rows(found) == expected


def test_no_rows(none):
    assert line_rules.score(none).count() == 0 and line_rules.clean(none).count() == 0


def test_query_on_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    expected = sorted((r["doc_id"], *brute(r["text"])) for r in docs.collect())
    assert rows(catalog.QUERIES["op1_line_rules"](spark, SMALL)) == expected


def test_clean_removes_failed_lines_alone(spark):
    good = "\n".join(" ".join(f"word{k}x{n}" for n in range(9)) + " ends." for k in range(12))
    docs = spark.createDataFrame([(1, f"Home | About | News | Contact\n{good}\nAll rights reserved.\nMenu")], "doc_id long, text string")
    assert [tuple(r) for r in line_rules.clean(docs).collect()] == [(1, good)]


@pytest.mark.parametrize("line, lost", [
    ("Home | About | Contact | News", True), ("### *** ###", True), ("Read our Privacy Policy now, please do.", True),
    ("Alle Rechte vorbehalten, auch die der Wiedergabe in Teilen.", True), ("今天天气很好。", False), ("他走了！", False), ("वह चला गया।", False),
    ("ماذا تريد؟", False), ("目录", True), ("Contents", True), ("He left.", False), ("“So it is.”", False), ("A longer heading that has many words", False), ("C# and F# are languages of some note.", False),
])
def test_rules(line, lost):
    assert bool(brute(line)[8]) == lost
    import pyarrow as pa

    assert bool(line_rules.judge(pa.array([line]), line_rules.Rules())["n_lost_lines"][0]) == lost
