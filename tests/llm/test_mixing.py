import hashlib
import random
from collections import defaultdict

from ledgerlens.llm.mixing import PRODUCTION, Mix, mixed


def fill(budget, nodes):
    """Whole shares of (name, weight, supply) nodes: those that run dry are filled, the rest goes by weight."""
    nodes = [n for n in nodes if n[1] > 0 and n[2] > 0]
    given, open_nodes = {}, sorted(nodes)
    while True:
        weight = sum(w for _, w, _ in open_nodes)
        dry = [n for n in open_nodes if n[2] * weight <= budget * n[1]]
        if not dry:
            break
        for n in dry:
            given[n[0]] = n[2]
            budget -= n[2]
        open_nodes = [n for n in open_nodes if n not in dry]
    upto = 0
    for name, w, _ in open_nodes:
        given[name] = budget * (upto + w) // weight - budget * upto // weight
        upto += w
    return given


def domain(source):
    digits = source[len(source.rstrip("0123456789")):]
    return f"domain{int(digits) % 4}" if digits else "other"


def brute(rows, mix):
    docs = []
    for i, text, lang, source in rows:
        n = len((text or "").split())
        if n:
            docs.append((i, domain(source or ""), lang or "", source or "", n))
    tokens = defaultdict(int)
    for _, d, l, s, n in docs:
        tokens[d, l, s] += n
    weight = lambda level, name: getattr(mix, level).get(name, mix.default)
    supply = {k: n * mix.epochs for k, n in tokens.items()}
    def over(keys):
        return sum(supply[k] for k in keys)
    usable = [k for k in supply if weight("domain", k[0]) > 0]
    top = fill(min(over(usable), sum(tokens.values()) * mix.numerator // mix.denominator), [
        (d, weight("domain", d), over([k for k in supply if k[0] == d])) for d in {k[0] for k in supply}])
    out = []
    for d, b in top.items():
        mine = [k for k in supply if k[0] == d]
        for l, c in fill(b, [(l, weight("lang", l), over([k for k in mine if k[1] == l])) for l in {k[1] for k in mine}]).items():
            leaves = [k for k in mine if k[1] == l]
            for s, e in fill(c, [(k[2], weight("source", k[2]), supply[k]) for k in leaves]).items():
                whole, rest = divmod(e, tokens[d, l, s])
                own = [x for x in docs if x[1:4] == (d, l, s)]
                own.sort(key=lambda x: (hashlib.md5(f"{mix.seed}:{whole + 1}:{'' if x[0] is None else x[0]}".encode()).hexdigest(), x[0] or 0, x[4]))
                for x in own:
                    part = max(0, min(x[4], rest))
                    rest -= part
                    if whole or part:
                        out.append((*x, whole, part, whole * x[4] + part))
    return sorted(out, key=str)


def corpus(rng, n=400):
    sources = ["src0"] * 6 + [f"src{i}" for i in range(1, 9)] + ["web", None]
    return [(i, "w " * rng.randrange(0, 60), rng.choice(["en", "en", "de", "xx", None]), rng.choice(sources)) for i in range(n)]


def test_selection_is_that_of_a_plain_filling(documents):
    rows = corpus(random.Random(2)) + [(None, "a b c", "en", "src1"), (7000, None, None, None), (7001, " \n", "en", "src0"), (3, "a b", "en", "src2"), (3, "a b", "en", "src2")]
    docs = documents(rows)
    for mix in (PRODUCTION, Mix(numerator=1, denominator=3, epochs=1), Mix(domain={"domain1": 0}, lang={"en": 9}, numerator=3, epochs=2), Mix(default=0)):
        got = sorted((tuple(r) for r in mixed(docs, mix).collect()), key=str)
        assert got == brute(rows, mix)


def test_budget_adds_up_and_seeds_differ(documents):
    rows = corpus(random.Random(3))
    total = sum(len(t.split()) for _, t, _, _ in rows)
    one = mixed(documents(rows), Mix(numerator=1, denominator=2, epochs=2, seed=1)).collect()
    two = mixed(documents(rows), Mix(numerator=1, denominator=2, epochs=2, seed=2)).collect()
    assert sum(r["n_used"] for r in one) == sum(r["n_used"] for r in two) == total // 2
    assert {r["doc_id"] for r in one} != {r["doc_id"] for r in two}


def test_empty_table(documents):
    assert mixed(documents([])).count() == 0
