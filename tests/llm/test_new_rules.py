"""Filter audit, fill-in-middle and quality rules against their SQL and plain versions."""

import hashlib
import itertools
import os
import random
import re
import subprocess
import sys

import pytest
from compare import compare, oracle_connection

from landfall.llm import fill_in_middle as fim
from landfall.llm import filter_audit, quality_rules
from landfall.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_fill_in_middle", "op13_quality_rules"])
def test_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), oracle_connection(FOLDER), ORACLE[name]) is None


# filter audit


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in docs:
        key = (i is None, i or 0)
        least[text or ""] = min(least.get(text or "", key), key)
    parts = {}
    for i, text, lang in docs:
        t = text or ""
        words = WORD.findall(t)
        fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search("[#$%&*|]", t)), (i is None, i or 0) > least[t]]
        parts.setdefault(lang or "", []).append((fails, i in good, i in toxic))
    rows = []
    for part, those in parts.items():
        for order in itertools.permutations(range(5)):
            left = list(those)
            for step, f in enumerate(order, 1):
                hit = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                failing = [d for d in those if d[0][f]]
                rows.append([part, "".join("ABCDE"[x] for x in order), step, len(left), len(hit), len(failing) - len(hit), sum(sum(d[0]) == 1 for d in failing),
                             sum(d[1] for d in hit), sum(d[2] for d in hit), "ABCDE"[f]])
    shares = {}
    for r in rows:
        shares[r[0], r[-1]] = shares.get((r[0], r[-1]), 0) + r[4]
    return sorted((*r[:-1], shares[r[0], r[-1]]) for r in rows)


@pytest.mark.parametrize("seed", range(3))
def test_audit_as_plain(spark, seed):
    pick = random.Random(seed)
    texts = [None, "", "a " * 250, "#", "Ab cd", "A" * 9, *(" ".join(f"w{pick.randint(0, 400)}" for _ in range(n)) + end for n in (199, 200, 260) for end in ("", " $", " ABCDEFGHIJKLMNOPQRSTUVWXYZABCDEFGHIJKLMNOPQRSTUVWXYZ"))]
    docs = [(pick.choice([None, *range(60)]), pick.choice(texts), pick.choice(["en", "de", "", None])) for _ in range(300)]
    labels = [(pick.choice([None, *range(60)]), pick.choice([0, 1, None]), pick.choice([0, 1, None])) for _ in range(50)]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, lang string, mask int, digest int")
    counts = filter_audit.combinations(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, filter_audit.interactions(counts).collect())) == plain_audit(docs, labels)


def test_audit_without_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.interactions(filter_audit.combinations(docs, labels)).count() == 0
    one = filter_audit.combinations(spark.createDataFrame([(1, None, None)], docs.schema), labels)
    rows = filter_audit.interactions(one).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and all(r.shapley == (120 if r.filter_order[r.step - 1] == "A" else 0) for r in rows)


def test_potentials_share_out_any_game(spark):
    pick = random.Random(5)
    worth = [0, *(pick.randint(0, 10**12) for _ in range(31))]
    rows = spark.createDataFrame([(worth,)], "n array<bigint>")
    share = [0] * 5
    for order in itertools.permutations(range(5)):
        done = 0
        for f in order:
            share[f] += worth[done | 1 << f] - worth[done]
            done |= 1 << f
    assert filter_audit.with_potentials(rows, 5).first().shapley == share


# fill-in-middle


def plain_fim(i, text, percent=100, spm=50):
    t, x = text or "", hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", t)
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not t or any(k in t for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, t
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("percent, spm", [(100, 50), (40, 0), (0, 50), (100, 100)])
def test_fim_as_plain(spark, percent, spm):
    pick = random.Random(percent)
    alphabet = ["a", "é", "😀", "\n", "\n", "<", "P", ">", "S>", "<M", "\r", " ", "\x00", " "]
    texts = [None, "", "\n", "\n\n", "x", "x\n", "<P>", "a<M>b\n", *("".join(pick.choices(alphabet, k=pick.randint(0, 40))) for _ in range(300)), "long line\n" * 300_000, "w" * 3_000_000]
    rows = [(pick.choice([None, *range(10**6)]), t) for t in texts]
    rows += rows[:3]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, form string").repartition(3)
    out = fim.restore(fim.fill_in_middle(docs, percent=percent, spm_percent=spm, size=1 << 12)).collect()
    assert len(out) == len(rows)
    for r in out:
        doc = r["row"].doc
        assert tuple(r["row"])[1:] == plain_fim(doc.doc_id, doc.text, percent, spm)
        assert r.restored == (doc.text or "") and (doc.n, doc.form) == (1, "x")


def test_fim_without_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fim.restore(fim.fill_in_middle(docs)).count() == 0


def test_fim_task_feeds_one_worker(spark):
    plan = QUERIES["op12_fill_in_middle"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan


def test_fim_kernels_stay_on_the_calling_thread():
    code = (
        "import os, pyarrow as pa; from landfall.llm import fill_in_middle as fim\n"
        "threads = lambda: len(os.listdir('/proc/self/task'))\n"
        "texts, before = pa.array(['', 'a', 'b\\nc\\n', 'x\\ny'] * 50_000, pa.large_string()), threads()\n"
        "made = fim.transformed(texts, [pa.array([k, 5, 1, 2] * 50_000, pa.int64()) for k in range(4)], 100, 50)\n"
        "assert len(made['output']) == 200_000 and threads() == before, (before, threads())"
    )
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code], cwd=home, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_fim_restores_bytes_and_refuses_other_forms(spark):
    outputs = [("psm", "<P><<S>é<S<M>😀>"), ("spm", "<S>é<P<P><<M>\n"), ("psm", "<P><S><M>x"), ("plain", "<M>a<P>"), ("plain", "")]
    rows = fim.restore(spark.createDataFrame([(*o, 1) for o in outputs], "form string, output string, first int")).collect()
    assert [r.restored for r in rows] == ["<😀>é<S", "<\né<P", "x", "<M>a<P>", ""] and all(r["row"]["first"] == 1 for r in rows)
    with pytest.raises(Exception, match="none of plain, psm and spm"):
        fim.restore(spark.createDataFrame([("pms", "x")], "form string, output string")).collect()


# quality rules


def plain_metrics(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    again = {i + k for places in seen.values() if len(places) > 1 for i in places for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again)


def test_rules_as_plain(spark):
    pick = random.Random(1)
    texts = [None, "", " \n ", "a", "a a a", "a a a a", "a b c a b", "a b c x a b c", "l\n l\nl\n\nl", "#*$%&|<>", "x y\x0bz\tx y z", "word " * 200_000]
    texts += ["".join(pick.choices(["a ", "b ", "c ", "\n", "#", "é ", "the "], k=pick.randint(0, 120))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, kept string")
    rows = quality_rules.apply_rules(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, chars, symbols, lines, again = plain_metrics(r.doc.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, again)
        assert r.base_failed == (n < 50 or 100 * again > 50 * n)
        assert r.kept == (not r.base_failed and not r.broken)
    assert quality_rules.apply_rules(docs.limit(0)).count() == 0


def test_rules_name_what_is_broken(spark):
    words = [f"word{i} of" for i in range(40)]
    texts = {
        "": " ".join(words), "symbols": " ".join(words) + "#" * 30, "words_with_letters": " ".join(words) + " 12" * 15 + " 13" * 15,
        "stop_words": " ".join(f"word{i}" for i in range(80)), "word_length": " ".join(f"{'x' * 20}{i} of" for i in range(40)),
        "duplicate_lines": "\n".join(words[:20] + ["of it"] * 30 + words[20:]), "ellipsis_lines": "...\n".join(words) + "…", "bullet_lines": "* " + "\n- ".join(words).replace("* ", ""),
    }
    rows = quality_rules.apply_rules(spark.createDataFrame(list(texts.items()), "name string, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.doc.name in r.broken or not r.doc.name and r.kept, (r.doc.name, r.broken)
    assert all(r.broken == [] for r in quality_rules.apply_rules(spark.createDataFrame([("x",)], "text string"), rules=()).collect())


def test_rules_are_one_projection_without_user_functions(spark):
    plan = QUERIES["op13_quality_rules"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
