"""Language, quality, mixing, licences, archives and neighbours: accuracy, round trips and plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwright.llm import forest, language, licenses, mixing, quality, warc
from linkwright.llm.common import table

SF = "/root/testdata/sf0.01"


def docs(spark, rows, extra="1L as n, 'x' as host, 'y' as path, 'z' as lang_pred, 2 as row, 3 as unit, 'b' as bucket"):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", *extra.split(", "))


EDGE = [(1, None, "de", "s"), (2, "", "de", None), (3, "123 !!", None, "s"), (None, "das ist ein satz", "de", "s"), (4, "this is a sentence " * 4000, "en", "s"), (4, "this is a sentence", "en", "s"), (5, "das ist ein satz und noch ein satz", "de", "t")]

# ---------------------------------------------------------------- language


def test_language_held_out_accuracy(spark):
    found = language.op2_language_id(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang", "text"), "doc_id")
    rows = found.where("held_out").collect()
    assert len(rows) > 150 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark):
    got = language.identify(spark, docs(spark, EDGE), F.lit(True)).collect()
    assert len(got) == len(EDGE)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.lang_pred)
    assert by[1] == by[2] == by[3] == ["und"] and by[4] == ["en", "en"] and by[None] == by[5] == ["de"]
    assert {r.lang_pred for r in language.identify(spark, docs(spark, EDGE), F.lit(False)).collect()} == {"und"}
    assert language.identify(spark, docs(spark, EDGE).limit(0), F.lit(True)).collect() == []


def plain_kneser_ney(counts):
    """p(last | three before) by the textbook recursion over dictionaries."""
    from collections import Counter, defaultdict

    levels = [counts]
    for _ in range(3):
        below = Counter()
        for g in levels[-1]:
            below[g[1:]] += 1
        levels.append(below)

    def discount(c):
        once, twice = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        return once / (once + 2 * twice) if once and twice else 0.5

    d = [discount(c) for c in levels[:3]] + [0.5]
    total, types = [defaultdict(float) for _ in levels], [defaultdict(int) for _ in levels]
    for k, c in enumerate(levels):
        for g, v in c.items():
            total[k][g[:-1]] += v
            types[k][g[:-1]] += 1

    def p(g, k=0):
        if k == 3:
            n = sum(levels[3].values())
            return max(levels[3].get(g, 0) - 0.5, 0) / n + 0.5 * len(levels[3]) / n / (len(levels[3]) + 1)
        low = p(g[1:], k + 1)
        t = total[k].get(g[:-1], 0)
        return low if not t else max(levels[k].get(g, 0) - d[k], 0) / t + d[k] * types[k][g[:-1]] / t * low

    return p


def test_kneser_ney_is_the_textbook_one():
    from collections import Counter

    y, owner, _ = language.symbols([b"the cat sat on the mat", "äöü the".encode(), b"that hat"])
    g = language.grams(y)[owner[3:] >= 0]
    hashes, n = np.unique(g, return_counts=True)
    model = language.kneser_ney(hashes, n)

    def letters(h):
        return tuple(int(h) >> s & 0xFFFF for s in (48, 32, 16, 0))

    p = plain_kneser_ney(Counter({letters(h): int(c) for h, c in zip(hashes, n)}))
    probes = list(hashes) + [np.uint64(int(h) ^ (5 << s)) for h in hashes[:20] for s in (0, 16, 32, 48)]
    assert np.allclose(language.log_p(model, np.array(probes, np.uint64)), [np.log(p(letters(h))) for h in probes])


def test_symbols_pad_and_squeeze():
    y, owner, has = language.symbols([b" a  B ", b"", "é9".encode()])
    assert bytes(y.astype(np.uint8)).decode("latin-1") == "   a b       é    "
    assert has.tolist() == [True, False, True]


def plain_language(rows, step=1 << 20):
    """{doc_id: cross-entropies by language} by the textbook recursion, learned from all rows."""
    from collections import Counter

    def grams_of(text):
        y, owner, _ = language.symbols([text.encode()])
        return [tuple(int(h) >> s & 0xFFFF for s in (48, 32, 16, 0)) for h in language.grams(y)[owner[3:] >= 0]]

    names = sorted({x for _, _, x, _ in rows})
    p = [plain_kneser_ney(sum((Counter(grams_of(t)) for _, t, x, _ in rows if x == name), Counter())) for name in names]
    return names, {d: [-np.mean([np.log(q(g)) for g in grams_of(t)]) for q in p] for d, t, _, _ in rows}


def test_language_by_every_path_is_the_textbook_one(spark):
    """A language of one short document beside frequent ones; whole models, few ready 4-grams, and tables."""
    rows = [(i, f"das ist ein satz und noch ein satz nummer {'abcdefghij'[i % 10] * 3} " * (1 + i % 3), "de", "s") for i in range(20)]
    rows += [(20, "to jest krótkie zdanie po polsku", "pl", "s"), (21, "this is a sentence and one more 𐐷𐐷", "en", "s")]
    names, want = plain_language(rows)
    for config in (language.Language(), language.Language(ready=10), language.Language(bound=0), language.Language(bound=0, ready=10)):
        got = {r.doc_id: r for r in language.identify(spark, docs(spark, rows), F.lit(True), config).collect()}
        assert got[20].lang_pred == "pl" and got[21].lang_pred == "en"
        assert all(r.lang_pred == names[int(np.argmin(want[d]))] and r.entropy == pytest.approx(min(want[d]), abs=1e-5) for d, r in got.items())


def test_language_tables_give_what_models_give(spark, sf):
    d = table(spark, sf, "documents")
    learn = F.col("doc_id") % 5 != 0
    one, other = ({r.doc_id: r for r in language.identify(spark, d, learn, c).collect()} for c in (language.Language(), language.Language(bound=0, ready=2000)))
    assert one.keys() == other.keys()
    for k, r in one.items():
        assert r.lang_pred == other[k].lang_pred and r.accepted == other[k].accepted
        assert r.score == pytest.approx(other[k].score, abs=1e-3) and (r.entropy or 0) == pytest.approx(other[k].entropy or 0, abs=1e-5)


# ---------------------------------------------------------------- quality


def test_quality_accuracy_on_unused_labels(spark):
    labels = table(spark, SF, "labels")
    rest = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    found = quality.classify(spark, table(spark, SF, "documents"), labels.where(~rest), F.col("source"), F.col("lang"))
    rows = found.join(labels.where(rest), "doc_id").collect()
    assert len(rows) > 80 and sum(r.rejected == (r.quality == 0) for r in rows) >= 0.97 * len(rows)
    assert not [r for r in rows if r.quality == 1 and r.rejected and r.p_document > 0.9]


def test_quality_site_posteriors(spark):
    """p_site against the formula, from the operator's own document probabilities."""
    rows = quality.op3_quality_classifier(spark, SF).join(table(spark, SF, "labels").groupBy("doc_id").agg(F.avg("quality").alias("y")), "doc_id", "left").collect()
    e = {id(r): r.y if r.y is not None else r.p_document for r in rows}
    mean = np.mean(list(e.values()))
    sites = {}
    for r in rows:
        sites.setdefault((r.host, r.path), []).append(r)
    for own in sites.values():
        # Leaving itself out moves a document's site away from its own evidence.
        assert len({round(r.p_site, 12) for r in own if e[id(r)] == 1.0}) <= 1
        for r in own:
            assert 0 < r.p_site < 1 and r.rejected == (r.p_quality < 0.5)
            z = np.log(r.p_document / (1 - r.p_document)) if 1e-6 < r.p_document < 1 - 1e-6 else None
            if z is not None:
                odds = z + np.log(r.p_site / (1 - r.p_site)) - np.log(mean / (1 - mean))
                assert abs(1 / (1 + np.exp(-odds)) - r.p_quality) < 1e-3


def plain_posteriors_of_sites(rows):
    """rows: (host, path, p_document, label or None). (p_site, p_quality) of each by the moments of its sites."""
    e = [p if y is None else y for _, _, p, y in rows]
    mean = sum(e) / len(e)

    def strength(groups):
        """groups: lists of evidence with the mean of what they shrink toward."""
        n = sum(len(g) for g, _ in groups)
        q = sum(len(g) * (sum(g) / len(g) - m) ** 2 for g, m in groups)
        noise, within = sum(m * (1 - m) for _, m in groups), sum(len(g) * m * (1 - m) for g, m in groups) / n
        return min(max(within / max((q - noise) / n, 1e-9) - 1, 1.0), 1e6)

    hosts, paths = {}, {}
    for x, (host, path, _, _) in zip(e, rows):
        hosts.setdefault(host, []).append(x)
        paths.setdefault((host, path), []).append(x)
    k = strength([(g, mean) for g in hosts.values()])
    m_host = {h: (sum(g) + k * mean) / (len(g) + k) for h, g in hosts.items()}
    k = strength([(g, m_host[h]) for (h, _), g in paths.items()])
    logit = lambda p: np.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    out = []
    for x, (host, path, p, _) in zip(e, rows):
        g = paths[host, path]
        site = (sum(g) - x + k * m_host[host]) / (len(g) - 1 + k)
        out.append((site, 1 / (1 + np.exp(-(logit(p) + logit(site) - logit(mean))))))
    return out


def test_quality_against_plain_posteriors(spark):
    """The whole query: both strengths, host and path means, and the posterior, from p_document and labels."""
    rows = quality.op3_quality_classifier(spark, SF).join(table(spark, SF, "labels").groupBy("doc_id").agg(F.avg("quality").alias("y")), "doc_id", "left").collect()
    want = plain_posteriors_of_sites([(r.host, r.path, r.p_document, r.y) for r in rows])
    assert len(rows) == 1000
    for r, (site, p) in zip(rows, want):
        assert r.p_site == pytest.approx(site, abs=1e-9) and r.p_quality == pytest.approx(p, abs=1e-9) and r.rejected == (p < 0.5)


def test_quality_of_pages_by_url(spark):
    """Hosts and paths of urls: a sparse path is drawn toward its host, a sparse host toward all."""
    good, bad = "some words of ordinary prose, told one after another. " * 5, "$$$ ### buy buy buy buy buy ||| &&& " * 5
    rows = [(i, f"http://{h}.org/{p}/{i}", good if ok else bad) for i, (h, p, ok) in enumerate([("a", "x", True)] * 30 + [("b", "x", False)] * 30 + [("b", "y", False)] * 2 + [("c", "z", True)] * 2)]
    d = spark.createDataFrame(rows, "doc_id long, url string, text string")
    labels = spark.createDataFrame([(i, int(t == good)) for i, _, t in rows if i % 2], "doc_id long, quality int")
    got = quality.classify(spark, d, labels, *quality.url_site(F.col("url"))).collect()
    site = {(r.host, r.path): r.p_site for r in got}
    assert site["a.org", "x"] > site["c.org", "z"] > site["b.org", "y"] >= site["b.org", "x"]
    want = plain_posteriors_of_sites([(r.host, r.path, r.p_document, float(rows[r.doc_id][2] == good) if r.doc_id % 2 else None) for r in got])
    assert all(r.p_site == pytest.approx(w[0], abs=1e-9) for r, w in zip(got, want))


def test_quality_edges(spark):
    d = docs(spark, EDGE)
    labels = spark.createDataFrame([(1, 0), (4, 1), (4, 1), (5, None), (None, 1), (5, 7)], "doc_id long, quality int")
    assert len(quality.classify(spark, d, labels, F.col("source"), F.col("lang")).collect()) == len(EDGE)
    none = quality.classify(spark, d, labels.limit(0), F.col("source"), F.col("lang")).collect()
    assert len(none) == len(EDGE) and not any(r.rejected for r in none)
    assert quality.classify(spark, d.limit(0), labels, F.col("source"), F.col("lang")).collect() == []


def test_url_sites(spark):
    host, path = quality.url_site(F.col("u"))
    d = spark.createDataFrame([("https://a.example.org/x/y?z=1",), ("https://a.example.org",), (None,)], "u string")
    assert [tuple(r) for r in d.select(host, path).collect()] == [("a.example.org", "x"), ("a.example.org", ""), (None, "")]


# ---------------------------------------------------------------- mixing


@pytest.mark.parametrize("sf, shares", [(SF, {"junk": 0.8, "clean": 0.8}), ("/root/testdata/sf0.1", {"junk": 0.8, "toxic": 0.8, "clean": 0.8})])
def test_mixing_meets_targets(spark, sf, shares):
    """Documents that were fitted on are scored without their own fold: held-out accuracy, of 400 and of 4,000 labels."""
    rows = mixing.op10_mixing(spark, sf).collect()
    total = sum(r.n_tokens for r in rows)
    for d, share in mixing.TARGETS.items():
        assert abs(sum(r[f"p_{d}"] * r.tokens for r in rows) / total - share) < 1e-5
    assert all(r.rate >= 0 for r in rows) and all(abs(sum(r[f"p_{d}"] for d in mixing.TARGETS) - 1) < 1e-9 for r in rows)
    truth = {r.doc_id: r.domain for r in mixing.label_domains(table(spark, sf, "labels")).collect()}
    known = [r for r in rows if r.doc_id in truth]
    for domain, share in shares.items():
        own = [r for r in known if truth[r.doc_id] == domain]
        assert sum(max(mixing.TARGETS, key=lambda d: r[f"p_{d}"]) == domain for r in own) >= share * len(own)


def plain_posteriors(rows, domain_of, domains, fold_of, config=mixing.Mixing()):
    """{doc_id: probabilities} by dictionaries of tokens."""
    import re
    from collections import Counter

    def tokens(text):
        words = text.lower().split()
        return Counter(re.findall(r"[^\W_]+|[^\w\s]+|_+", " ".join(words)) + ["\1"] * sum(a == b for a, b in zip(words, words[1:])))

    bags, out = {d: tokens(t) for d, t in rows}, {}
    prior = [np.log((sum(x == y for x in domain_of.values()) + 1) / (len(domain_of) + len(domains))) for y in domains]
    for f in range(config.folds + 1):
        own = [d for d in bags if d in domain_of and fold_of[d] != f]
        n = np.array([sum(domain_of[d] == y for d in own) for y in domains], float)
        c, held = ({t: np.zeros(len(domains)) for d in own for t in bags[d]} for _ in range(2))
        for d in own:
            for t, x in bags[d].items():
                c[t][domains.index(domain_of[d])] += x
                held[t][domains.index(domain_of[d])] += 1
        total = sum(c.values())
        for d in bags:
            if (fold_of[d] if d in domain_of else config.folds) != f:
                continue
            s = np.array(prior)
            for t, x in bags[d].items():
                if t in c:
                    share = n / n.sum()
                    z = (held[t] - held[t].sum() * share) ** 2 / (held[t].sum() * share * (1 - share) + 0.5)
                    w = np.log((c[t] + config.shrink) / (c[t].sum() * total / total.sum() + config.shrink))
                    s = s + x * w * (z / (z + config.doubt * (1 - len(domains) / n.sum()))) ** 3
            e = np.exp(s - s.max())
            out[d] = e / e.sum()
    return out


def test_posteriors_against_plain_ones(spark, sf):
    from linkwright.llm.common import Work

    d = table(spark, sf, "documents").limit(120).select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    labelled = mixing.label_domains(table(spark, "/root/testdata/sf0.001", "labels"))
    domains, known = sorted(mixing.TARGETS), {r.doc_id for r in d.collect()}
    domain_of = {r.doc_id: r.domain for r in labelled.collect()}
    config = mixing.Mixing(buckets=1 << 30)
    fold_of = {r[0]: r[1] for r in spark.createDataFrame([(x,) for x in domain_of], "doc_id long").select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(config.folds))).collect()}
    got = mixing.posteriors(spark, Work(spark, "t"), d, labelled, domains, config).collect()
    priors_of = {x: y for x, y in domain_of.items()}
    want = plain_posteriors(rows, {x: y for x, y in priors_of.items()}, domains, fold_of, config)
    assert len(got) == len(known) and all(np.allclose([r[f"p_{i}"] for i in range(len(domains))], want[r.doc_id], atol=1e-6) for r in got)


def test_mixing_adds_up_weak_words(spark):
    """Each word's weight is below 0.05, but all point the same way."""
    up, down = [f"up{x}" for x in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMN"], [f"down{x}" for x in range(40)]
    rows = [(1, " ".join(up * 105 + down * 95), "", ""), (2, " ".join(up * 95 + down * 105), "", ""), (3, " ".join(up), "", ""), (4, " ".join(down), "", "")]
    labelled = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, domain string")
    got = {r.doc_id: r for r in mixing.mix(spark, docs(spark, rows), labelled, {"a": 0.5, "b": 0.5}).collect()}
    assert got[3].p_a > 0.9 and got[4].p_b > 0.9


def test_rates_against_a_plain_descent(spark):
    r = random.Random(3)
    rows = []
    for _ in range(200):
        p = [r.random() ** 3 for _ in range(3)]
        rows.append((r.randrange(0, 500), *(x / sum(p) for x in p)))
    members = spark.createDataFrame(rows, "n_tokens long, p_0 double, p_1 double, p_2 double")
    targets = [0.9, 0.07, 0.03]
    got = [x.rate for x in mixing.fit_rates(spark, members, targets, mixing.Mixing(steps=60)).collect()]
    n, p = np.array([x[0] for x in rows], float), np.array([x[1:] for x in rows])
    goal = np.array(targets) * n.sum()
    rate = np.ones(len(n))
    m = (p * n[:, None]).T @ p
    for _ in range(20000):
        short = (rate * n) @ p - goal
        rate = np.maximum(0, rate - 0.3 * p @ (short / np.diag(m)))
    assert np.abs((np.array(got) * n) @ p - (rate * n) @ p).max() < 1e-3 * n.sum()


def test_mixing_edges(spark):
    d = docs(spark, EDGE)
    labels = spark.createDataFrame([(4, "a"), (5, "b"), (None, "a"), (1, None), (2, "other")], "doc_id long, domain string")
    got = mixing.mix(spark, d, labels, {"a": 0.5, "b": 0.5}).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 4), (1, 0), (2, 0), (3, 2), (4, 4), (4, 16000), (5, 8)]
    assert all(r.rate == 1 for r in got if r.n_tokens == 0)
    assert len(mixing.mix(spark, d, labels.limit(0), {"a": 0.5, "b": 0.5}).collect()) == len(EDGE)
    assert mixing.mix(spark, d.limit(0), labels, {"a": 1.0}).collect() == []


# ---------------------------------------------------------------- licences


def plain_dice(text, notices):
    found = {}
    for unit in dict.fromkeys([*text.split("\n"), *__import__("re").split("\n[ \t]*\n", text), text]):
        a, here = set(licenses.bigrams(unit)), {}
        for licence, notice in notices:
            b = set(licenses.bigrams(notice))
            if a and 2 * 10 * len(a & b) >= 8 * (len(a) + len(b)):
                here[licence] = max(here.get(licence, 0), round(2 * len(a & b) / (len(a) + len(b)), 6))
        for licence, dice in here.items():
            if dice == max(here.values()):
                found[licence] = max(found.get(licence, 0), dice)
    return found


def test_every_match_has_a_key_word():
    rows = licenses._notice_rows(licenses.NOTICES, licenses.Licenses())
    words = set(licenses.key_words(rows))
    for i, (_, text) in enumerate(licenses.NOTICES):
        least, found = next(r[3] for r in rows if r[0] == i), licenses.bigrams(text)
        assert sum(not words & set(x.split(" ")) for x in found) < least
    assert licenses.key_words([(0, "x", 1, 1, 1, "word")]) == ["word"]


def test_only_the_best_licence_of_a_passage(spark):
    """Each notice alone, as a line and within prose, is told from those that share most of its words."""
    prose = " and so it went on, word after word, until it came to an end. "
    rows = [(i, t, "", "") for i, (_, t) in enumerate(licenses.NOTICES)] + [(100 + i, prose + t + prose, "", "") for i, (_, t) in enumerate(licenses.NOTICES)]
    got = {}
    for r in licenses.scan(spark, docs(spark, rows)).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    for i, (_, text) in enumerate(licenses.NOTICES):
        assert got[i] == got[100 + i] == {x for x, t in licenses.NOTICES if t == text}


def test_licenses(spark):
    mit = next(t for _, t in licenses.NOTICES if t.startswith("Permission is hereby"))
    texts = [None, "", "x", "Released under the MIT License.", "code\n" + mit.replace("software", "program", 1) + "\nmore", "\n".join(mit.split(", ")), "Licensed under CC BY-NC 4.0 " * 2, "a\n\nLicensed under\nthe Apache License,\nVersion 2.0.\n\nb"]
    d = docs(spark, [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, texts[3], "en", "s"), (3, texts[3], "en", "s")])
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.license, r.dice) for r in licenses.scan(spark, d).collect())
    want = [(i, k, v) for i, t in enumerate(texts) if t for k, v in plain_dice(t, licenses.NOTICES).items()]
    assert got == sorted([*want, (-1, "MIT", 1.0), (3, "MIT", 1.0)])
    assert {g[0] for g in got} == {-1, 3, 4, 5, 6, 7}
    assert licenses.scan(spark, d.limit(0)).collect() == []


# ---------------------------------------------------------------- archives


def test_licenses_inside_larger_units(spark):
    """Comment blocks, unwrapped texts and sentences in prose hold notices that no unit is close to."""
    prose = "some words of other prose that go on for a while, one after another, without an end in sight. "
    mit = "MIT License. Copyright (c) 2020 Somebody. " + licenses.NOTICES[4][1] + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + licenses.NOTICES[5][1]
    gpl = prose + next(t for x, t in licenses.NOTICES if x == "GPL-3.0" and "redistribute" in t) + " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY. " + prose

    def block(text):
        w = text.split()
        return "/*\n" + "\n".join(" * " + " ".join(w[i : i + 9]) for i in range(0, len(w), 9)) + "\n */\nint main() {}"

    rows = [(1, block(mit), "", ""), (2, mit, "", ""), (3, block(gpl), "", ""), (4, prose + "Released under the MIT License. " + prose, "", ""), (5, prose * 300, "", ""), (6, "the license " * 500 + "released under the license", "", "")]
    got = sorted((r.doc_id, r.license, r.dice, r.n_units) for r in licenses.scan(spark, docs(spark, rows)).collect())
    assert [g[:2] for g in got] == [(1, "MIT"), (2, "MIT"), (3, "GPL-3.0"), (4, "MIT")]
    assert all(g[2] == 1 for g in got) and not any(g[3] for g in got)


def test_warc_round_trip(spark):
    big, other = "ü" * 700, "é" * 499
    rows = [(1, "http://a/1", big), (7, None, big), (3, "http://a/ 3", big), (4, "u", other), (5, "u", other), (6, "u", None), (8, "u", ""), (None, "u", big), (7, "v", big), (9, "u", "a\r\n\r\nb" * 300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'d' as digest", "1 as top")
    for config in (warc.Warc(), warc.Warc(archive=1000, zip64=True)):
        got = warc.archive_pages(spark, pages, config).collect()
        assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in got) == sorted(
            [(1, "revisit", 7, 1400), (3, "revisit", 7, 1400), (7, "response", 0, 1400), (7, "response", 0, 1400), (0, "response", 0, 1400), (4, "response", 0, 998), (5, "response", 0, 998), (6, "response", 0, 0), (8, "response", 0, 0), (9, "response", 0, 1800)]
        )
        want = {k: (h or "").encode() for k, _, h in rows}
        assert all(r.payload is None if r.record_type == "revisit" else bytes(r.payload) == want[r.page_id] for r in got)
    assert warc.archive_pages(spark, pages.limit(0)).collect() == []


def test_zip_directories():
    import io
    import zipfile

    records, index = b"one" * 50, b"3\n" * 50
    for zip64 in (False, True):
        packed = warc.pack(records, index, zip64)
        read = lambda at, n, p=packed: p[at : at + n]
        members = warc.stored_members(read, len(packed))
        assert {k: read(*v) for k, v in members.items()} == {warc.RECORDS: records, warc.INDEX: index}
        assert zipfile.ZipFile(io.BytesIO(packed)).read(warc.RECORDS) == records
    noted = io.BytesIO()
    with zipfile.ZipFile(noted, "w") as z:
        z.writestr("a", b"data")
        z.comment = b"a note with PK\5\6 in it"
    data = noted.getvalue()
    assert list(warc.stored_members(lambda at, n: data[at : at + n], len(data))) == ["a"]
    squeezed = io.BytesIO()
    with zipfile.ZipFile(squeezed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"data" * 100)
    data = squeezed.getvalue()
    with pytest.raises(ValueError, match="stored"):
        warc.stored_members(lambda at, n: data[at : at + n], len(data))
    with pytest.raises(ValueError, match="end record"):
        warc.stored_members(lambda at, n: b"nothing here"[at : at + n], 12)


# ---------------------------------------------------------------- neighbours


def test_recall_against_brute_force(spark):
    rows = table(spark, SF, "embeddings").select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in forest.op8_nearest_neighbours(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = 0
    for q in ids[ids % 20 == 0]:
        score = x @ x[ids == q][0]
        order = [k for k in np.lexsort([ids, -score]) if ids[k] != q][:20]
        hits += len({ids[k] for k in order} & {v for v, _ in got[q]})
        assert len(got[q]) == 20 and got[q] == sorted(got[q], key=lambda t: (-t[1], t[0]))
        assert all(abs(s - score[ids == v][0]) < 1e-12 for v, s in got[q])
    assert hits >= 0.9 * 20 * (ids % 20 == 0).sum()


def test_neighbour_edges(spark):
    bad = [(20, None), (40, [0.0, 0.0]), (60, [1.0, None]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]), (120, [1.0]), (None, [1.0, 2.0])]
    good = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 5.0]), (1, [2.0, 0.0]), (-20, [0.5, 0.5])]
    v = spark.createDataFrame(bad + good, "vec_id long, embedding array<float>").selectExpr("*", "1 as q", "2 as b", "'x' as v")
    got = forest.nearest_neighbours(spark, v, F.pmod("vec_id", F.lit(20)) == 0).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got if r.query_id == 0] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, -20, 0.5), (0, 4, 3, -1.0)]
    assert {r.query_id for r in got} == {0, -20}
    assert forest.nearest_neighbours(spark, v.limit(0), F.lit(True)).collect() == []
    assert forest.nearest_neighbours(spark, v, F.lit(False)).collect() == []
