"""Quality rules against a plain version, native plans, planted lines."""

import random
import re

import duckdb
import pytest

from ebbflow.llm import quality
from ebbflow.llm.oracles import ORACLES
from ebbflow.llm.queries import op5_quality_rules

SPACE = " \t\n\x0b\x0c\r"


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, windows = {}, [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    repeat = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    n = len(words)
    failed = n < 10 or 100 * len(repeat) > 20 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeat), failed


def norm(line):
    return re.sub("[0-9]", "0", re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" "))


def brute_kept(rows, max_docs=quality.MAX_DOCS):
    """Whether each (id, text, host) is kept."""
    at, spread = {}, {}
    texts = {(host, text): [x for x in map(norm, (text or "").split("\n")) if x] for _, text, host in rows}
    for (host, text), lines in texts.items():
        for i, x in enumerate(lines):
            docs, before, after = at.setdefault((host, x), (set(), set(), set()))
            docs.add(text)
            before.update(lines[i - 1 : i] if i else [])
            after.update(lines[i + 1 : i + 2])
    above = {k for k, (d, _, _) in at.items() if len(d) > max_docs}
    for (host, _), lines in texts.items():
        i = 0
        while i < len(lines):
            j = i
            while j < len(lines) and (host, lines[j]) in above:
                j += 1
            if j > i:  # a run of lines above the limit
                before, after = spread.setdefault((host, tuple(lines[i:j])), (set(), set()))
                before.update(lines[i - 1 : i] if i else [])
                after.update(lines[j : j + 1])
            i = max(j, i + 1)
    around = {}
    for (host, run), (b, a) in spread.items():
        for x in run:
            around[host, x] = max(around.get((host, x), 0), len(b), len(a))
    common = {k for k in above if max(len(at[k][1]), len(at[k][2]), around[k]) >= 0.5 * len(at[k][0])}
    out = {}
    for doc_id, text, host in rows:
        sizes = [(len(x.split(" ")), (host, x) in common) for x in texts[host, text]]
        left, total = sum(n for n, c in sizes if not c), sum(n for n, _ in sizes)
        out[doc_id] = not base(text)[-1] and not (total and left < 0.2 * total)
    return out


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    kept = brute_kept(rows)
    got = {r["doc_id"]: r for r in op5_quality_rules(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    for doc_id, text, _ in rows:
        assert tuple(got[doc_id][n] for n in NAMES) == base(text)
        assert got[doc_id]["kept"] == kept[doc_id]


def test_plan_is_native(spark):
    plan = op5_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|RDD", plan)


def planted():
    rng = random.Random(2)
    line = lambda n: " ".join(f"w{rng.randrange(9999)}" for _ in range(n))
    notice = "Accept  all cookies to go on reading this fine page of ours 2020"
    rows = []
    for i in range(40):  # the notice among own lines, and documents that are nearly nothing else
        rows.append((i, "\n".join([line(20), notice.replace("2020", str(2000 + i)), line(30)]), "a"))
        rows.append((100 + i, "\n".join([line(2), notice, notice.upper()]), "a"))
    copy = [line(12), line(14), line(9)]
    for i in range(60):  # light edits of one clean text stay, here
        rows.append((200 + i, "\n".join([*copy, f"edit {i}"]), "a"))
        rows.append((300 + i, "\n".join([copy[0] + f" {line(1)}", *copy[1:]]), "a"))
    rows += [(500 + i, "\n".join([line(2), notice, notice.upper()]), "b") for i in range(5)]  # below the limit of another host
    return rows


def test_common_lines_deplete_documents(spark):
    rows = planted()
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, base int, host string")
    got = {r["doc_id"]: r["kept"] for r in quality.quality_report(frame).collect()}
    assert got == brute_kept(rows)
    assert not any(got[100 + i] for i in range(40)) and all(got[i] for i in [*range(40), *range(200, 260), *range(300, 360), *range(500, 505)])
    assert quality.passing(frame).columns == frame.columns
    lines = quality.host_lines(frame)
    clean = {r["doc_id"]: r["clean_text"] for r in quality.remove_common_lines(frame, quality.common_lines(lines)).collect()}
    assert "cookies" not in clean[3] and clean[3].count("\n") == 1 and "cookies" in clean[500]


def test_edge_rows(spark):
    texts = [None, "", " \n\t\n", "one two three four five six seven eight nine ten", "a b c d e " * 3, "x\n" * 30, "w " * 50_000, "# * $ % & | < >", "é ß x " * 12]
    rows = [(i, t, None if i % 2 else "h") for i, t in enumerate(texts)] + [(3, texts[3], None), (None, texts[3], "h")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, word_list int")
    got = [tuple(r) for r in quality.quality_report(frame).select("doc_id", *NAMES).collect()]
    assert sorted(got, key=str) == sorted([(i, *base(t)) for i, t, _ in rows], key=str)
    assert quality.quality_report(frame.limit(0)).count() == 0


def blocks():
    """Blocks of five lines at the start, in the middle and at the end of documents, and lightly edited copies of a clean text."""
    rng = random.Random(8)
    line = lambda n: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))
    rows, found = [], {h: [line(9) for _ in range(5)] for h in ("start", "middle", "end")}
    for i in range(40):
        for k, (host, block) in enumerate(found.items()):
            own = [line(30), line(30)]
            rows.append((1000 * k + i, "\n".join({"start": block + own, "middle": own[:1] + block + own[1:], "end": own + block}[host]), host))
            short = [line(4)]  # the notice and one sentence
            rows.append((1000 * k + 500 + i, "\n".join({"start": block + short, "middle": [line(2), *block, line(2)], "end": short + block}[host]), host))
    clean = [line(10) for _ in range(20)]
    for i in range(200):  # copies of a clean text, each with one line of its own somewhere
        text = list(clean)
        text[i % 20] = line(10)
        rows.append((9000 + i, "\n".join(text), "copies"))
    return rows


def test_lines_of_notices_of_several_lines_are_common(spark):
    rows = blocks()
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality.quality_report(frame).collect()}
    assert got == {i: i >= 9000 or i % 1000 < 500 for i, _, _ in rows}
    common = quality.common_lines(quality.host_lines(frame))
    assert {r["host"]: r["count"] for r in common.groupBy("host").count().collect()} == {"hstart": 5, "hmiddle": 5, "hend": 5}


def three_line_copies():
    """Copies of three lines, half of them with a line of their own after it, and texts of common lines alone."""
    rng = random.Random(12)
    line = lambda n: " ".join(f"w{rng.randrange(9999)}" for _ in range(n))
    three = [line(8) for _ in range(3)]
    rows = [(i, "\n".join(three + ([line(6)] if i % 2 else [])), "a") for i in range(60)]
    return rows + [(100 + i, "\n".join([three[0], line(5), three[2]]), "a") for i in range(30)] + [(200, "\n".join(three), None)]


@pytest.mark.parametrize("made", [blocks, planted, three_line_copies])
def test_oracle_and_brute_force_know_runs_of_lines(spark, tmp_path, made):
    rows = made()
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality.quality_report(frame).collect()}
    assert got == brute_kept(rows)
    frame.coalesce(1).write.parquet(f"{tmp_path}/documents")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    found = con.sql(ORACLES["op5_quality_rules"])
    at = found.columns.index("doc_id"), found.columns.index("kept")
    assert {r[at[0]]: r[at[1]] for r in found.fetchall()} == got
