"""Quality rules: measurements against plain Python, policies and ablations against loops."""

import random
import re
from collections import Counter

from alertfold.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, fails string, words int, h long"


def measured(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), len(lines), sum(c in "0123456789" for c in text),
            sum("A" <= c <= "Z" for c in text))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


def texts():
    rng = random.Random(3)
    out = [None, "", " \n\t ", "a", "one\none\none \n\none", "x " * 100, "a b c d e f g h " * 3, "é ß #|<>&%$* 12",
           "w" * 30_000, " ".join(str(i) for i in range(20_000)), "p q r s t u v w\x0bp\x0cq\rr s t u v w",
           "LOUD " * 30, "\n".join(["same line"] * 50 + [str(i) + " other" for i in range(20)])]
    for _ in range(60):
        words = [rng.choice(["aa", "b", "ccc", "d#", "É"]) for _ in range(rng.randint(1, 80))]
        out.append("".join(w + rng.choice([" ", "  ", "\n", "\t"]) for w in words))
    long = [str(rng.randint(0, 10 ** 6)) for _ in range(30_000)]
    out.append(" ".join(long + long[500:560] + ["end"] + long[540:600]))
    return out


def test_measurements_match_plain_python(spark):
    given = texts()
    rows = [*enumerate(given), (None, given[5]), (5, given[5])]
    got = Q.measure(docs(spark, rows)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted((str(i), *measured(t)) for i, t in rows)


def failing(m):
    n, chars, symbols, dup, repeat, lines, digits, capitals = m
    return [n < 20, 100 * repeat > 30 * n, 10 * symbols > n, 100 * dup > 40 * lines,
            n > 0 and not 2 * n <= chars <= 20 * n, 100 * digits > 50 * chars, 100 * capitals > 60 * chars]


def test_ledger_policies_and_ablations_match_loops(spark):
    given = list(enumerate(texts()))
    entries = Q.ledger(docs(spark, given)).cache()
    want = {i: failing(measured(t)) for i, t in given}
    names = [r.name for r in Q.RULES]
    for r in entries.withColumn("names", Q.failed_rules(entries.fails)).collect():
        assert r.fails == sum(f << k for k, f in enumerate(want[r.doc_id]))
        assert r.names == [names[k] for k, f in enumerate(want[r.doc_id]) if f]

    def keeps(policy, fails):
        hard = any(f for k, f in enumerate(fails) if policy.hard >> k & 1)
        return not hard and sum(f for k, f in enumerate(fails) if policy.soft >> k & 1) <= policy.forgiven

    policies = [*Q.POLICIES.values(), Q.Policy("soft", 0, (1 << len(names)) - 1, 2)]
    for policy in policies:
        got = {r.doc_id: (r.kept, r.base_failed, r.policy) for r in Q.apply_policy(entries, policy).collect()}
        assert got == {i: (keeps(policy, f) and not (f[0] or f[1]), f[0] or f[1], policy.version) for i, f in want.items()}
    table = {(r.policy, r.rule): r for r in Q.ablations(entries, policies).collect()}
    assert len(table) == len(policies) * len(names)
    for policy in policies:
        for k, name in enumerate(names):
            r, others = table[policy.version, name], (policy.hard | policy.soft) & ~(1 << k)
            assert r.docs == len(want)
            assert r.kept == sum(keeps(policy, f) for f in want.values())
            assert r.failed == sum(f[k] for f in want.values())
            assert r.failed_alone == sum(f[k] and not any(x for j, x in enumerate(f) if others >> j & 1)
                                         for f in want.values())
            assert r.kept_without == sum(keeps(policy.without(1 << k), f) for f in want.values())


def test_an_empty_table(spark):
    none = docs(spark, [])
    assert Q.apply_policy(Q.ledger(none), Q.POLICIES[Q.CURRENT]).collect() == []
    assert Q.ablations(Q.ledger(none), Q.POLICIES.values()).collect() == []


def test_no_python_and_no_shuffle_in_the_plan(spark):
    plan = Q.ledger(docs(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
