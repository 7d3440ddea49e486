"""Fill-in-the-middle, the filter audit and language identification against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazar.llm import fill_in_middle, filter_audit, language_id, quality_rules
from bazar.llm.text import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_middle(key, text):
    text, lines = text or "", re.findall(r"[^\n]*\n|[^\n]+", text or "")
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, _, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted([h1 % (len(lines) + 1), h2 % (len(lines) + 1)])
    prefix, middle, suffix = ("".join(part) for part in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(lines), "plain", None, None, text
    if h4 % 100 < 50:
        return len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def ranks(rng, bounds):
    return np.array([rng.randint(0, b - a) for a, b in itertools.pairwise(bounds)])


@pytest.mark.parametrize("seed", range(5))
def test_skip_list_reaches_every_rank(seed):
    rng = random.Random(seed)
    bounds = np.cumsum([0, *(rng.choice([1, 2, 7, 300, 5000]) for _ in range(12))])
    widths = np.array([(1, rng.randint(1, 90)) for _ in range(bounds[-1])])
    lanes = fill_in_middle.SkipList.of(widths, bounds[:-1])
    assert len(lanes.widths) > 3 and len(lanes.widths[-1]) == 12
    assert all(w.sum(axis=0).tolist() == widths.sum(axis=0).tolist() for w in lanes.widths)
    for at in (ranks(rng, bounds), np.zeros(12, int), np.diff(bounds)):
        got = lanes.passed(np.arange(12), at)
        assert got.tolist() == [widths[a : a + r].sum(axis=0).tolist() for a, r in zip(bounds, at)]


def middle_rows():
    rng = random.Random(3)
    lines = ["", "a", "日本語 é", "x" * 200, "<", "P>", "\r", "\x00", "<S", "M>"]
    rows = [(i, rng.choice(["\n", "\n\n", " "]).join(rng.choice(lines) for _ in range(rng.randint(0, 40))) + rng.choice(["", "\n"])) for i in range(300)]
    rows += [(400, "a<P>b"), (401, "\n"), (402, "\n\n\n"), (403, "no line feed"), (404, "line\n" * 200_000), (405, "é" * 400_000), (None, "x\ny\nz"), (5, "other\ntext"), (5, "other\ntext")]
    return rows


def test_fill_in_middle_is_brute_force(ready, messy, nothing):
    rows = middle_rows()
    docs = ready.createDataFrame(rows, "doc_id bigint, text string").unionByName(messy.select("doc_id", "text"))
    got = fill_in_middle.fill_in_middle(docs).withColumn("back", fill_in_middle.restored()).collect()
    want = Counter((r.doc_id, *brute_middle(r.doc_id, r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == want
    assert all(r.back == (r.text or "") for r in got) and {r.form for r in got} == {"plain", "psm", "spm"}
    clash = fill_in_middle.fill_in_middle(messy.withColumn("output", F.lit(0)).withColumn("n", F.lit("x")))
    assert clash.columns == [*messy.columns, "n", "form", "prefix_chars", "middle_chars", "output"]
    assert {r.doc_id: r.n for r in clash.collect()}[5] == 2
    assert fill_in_middle.fill_in_middle(nothing).count() == 0


def test_rate_and_order_are_parameters(ready):
    docs = ready.createDataFrame([(i, "a\nb\nc") for i in range(400)], "doc_id bigint, text string")
    form = lambda **k: Counter(r.form for r in fill_in_middle.fill_in_middle(docs, **k).collect())
    assert form(rate=0) == {"plain": 400} and form(suffix_first=100) == {"spm": 400} and form(suffix_first=0) == {"psm": 400}
    assert 100 < form(rate=50)["plain"] < 300


def brute_audit(rows, labels):
    """(part, order, step) -> counts, by filtering in every order."""
    good, toxic = ({k for k, *flags in labels if flags[i] == 1 and k is not None} for i in (0, 1))
    least = {}
    for k, t, _ in rows:
        if k is not None:
            least[t or ""] = min(k, least.get(t or "", k))
    failed = []
    for k, t, _ in rows:
        t = t or ""
        words = WORD.findall(t)
        tests = (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t)), k is not None and k > least[t])
        failed.append({f for f, bad in zip("ABCDE", tests) if bad})
    out, shares = {}, Counter()
    for part in {s or "" for *_, s in rows}:
        mine = [i for i, r in enumerate(rows) if (r[2] or "") == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [i for i in left if f in failed[i]]
                left = [i for i in left if f not in failed[i]]
                shares[part, f] += len(gone)
                out[part, "".join(order), step] = (
                    len(left),
                    len(gone),
                    sum(f in failed[i] for i in mine) - len(gone),
                    sum(failed[i] == {f} for i in mine),
                    sum(rows[i][0] in good for i in gone),
                    sum(rows[i][0] in toxic for i in gone),
                )
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_is_brute_force(ready, messy, nothing):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)] + ["LOUD"] * 20 + ["#", "a|b", "é 日本"]
    texts = [" ".join(rng.choice(vocabulary[: rng.choice([30, 300, 323])]) for _ in range(rng.choice([5, 50, 90]))) for _ in range(60)]
    rows = [(i, rng.choice(texts), rng.choice(["s", "t", "", None])) for i in range(300)]
    # repeated keys with other parts, NULL keys with copies, and many rows of one text
    rows += [(3, rows[3][1], "t"), (3, rows[3][1], "u"), (None, texts[0], "s"), (None, texts[0], "s"), (None, "only here", "s")] + [(1000 + i, texts[1], "hot") for i in range(200)]
    rows += [(r.doc_id, r.text, r.source) for r in messy.collect()]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 330, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1), (9999, 1, 1)]
    flags = ready.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = ready.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("failed", F.lit("x")).repartition(5)
    got = filter_audit.audit(docs, flags)
    want = brute_audit(rows, labels)
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got.collect()} == want
    assert len(want) == 600 * len({s or "" for *_, s in rows})
    assert filter_audit.audit(nothing, flags).count() == 0
    assert filter_audit.audit(docs, flags.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_shapley_weights_are_those_of_all_orders():
    for players in (2, 3, 5):
        weights = filter_audit.shapley_weights(players)
        rng = random.Random(players)
        value = [0, *(rng.randint(-50, 50) for _ in range((1 << players) - 1))]
        for i, factors in enumerate(weights):
            total = 0
            for order in itertools.permutations(range(players)):
                before = sum(1 << f for f in order[: order.index(i)])
                total += value[before | 1 << i] - value[before]
            assert sum(k * v for k, v in zip(factors, value)) * math.factorial(players) == total


def brute_grams(text, longest, bits):
    """Buckets of a text's n-grams, one string at a time."""
    import unicodedata

    chars = " " + "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower()) + " "
    out = []
    for n in range(1, longest + 1):
        for i in range(len(chars) - n + 1):
            gram = chars[i : i + n]
            if " " in gram[1:-1] or not gram.strip(" "):
                continue
            code = ord(gram[0])
            for c in gram[1:]:
                code = ((code + 1) * int(language_id._STEP) + ord(c)) % 2**64
            out.append(int(mix(np.array([(code + n) % 2**64], np.uint64))[0]) >> (64 - bits))
    return out


def brute_languages(train, texts, longest, bits, smoothing=0.5):
    counts, documents = defaultdict(Counter), Counter()
    for text, lang in train:
        if lang is not None:
            documents[lang] += 1
            counts[lang].update(brute_grams(text, longest, bits))
    out = []
    for text in texts:
        grams = brute_grams(text, longest, bits)
        if not any(c.isalpha() for c in text or "") or not documents:
            out.append(("und", 0.0))
            continue
        scores = {}
        for lang in sorted(documents):
            norm = sum(counts[lang].values()) + smoothing * 2**bits
            scores[lang] = math.log(documents[lang] / sum(documents.values())) + sum(math.log((counts[lang][g] + smoothing) / norm) for g in grams)
        best = max(scores, key=scores.get)
        out.append((best, 1 / sum(math.exp(s - scores[best]) for s in scores.values())))
    return out


def language_rows():
    rng = random.Random(5)
    letters = {"xx": "abcde ", "yy": "defgh ", "zz": "ßéçñı ", "ww": "日本語漢字 ", "vv": "нетда "}
    rows = [(i, "".join(rng.choice(letters[lang]) for _ in range(rng.randint(1, 60))), lang) for i, lang in enumerate(rng.choices([*letters], k=200))]
    extra = [None, "", " 12 !", "İSTANBUL ǅ", "a", "नमस्ते दुनिया", "x" * 5000, "🙂", "def de", "a\x00b"]
    return rows + [(500 + i, t, rng.choice(["xx", None])) for i, t in enumerate(extra)] + [rows[0], rows[0], (None, "abc abc", "xx")]


@pytest.mark.parametrize("at_once, block", [(64, 1 << 18), (2, 1 << 18), (64, 7)])
def test_language_id_is_brute_force(ready, monkeypatch, at_once, block):
    monkeypatch.setattr(language_id, "LANGUAGES_AT_ONCE", at_once)
    rows = language_rows()
    docs = ready.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit("old")).repartition(3)
    if block == 7:  # n-grams over the ends of blocks
        monkeypatch.setattr(language_id, "BLOCK", block)
        for _, text, _ in rows:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            found = np.concatenate([b for _, b in language_id.Grams.of(raw, np.array([0, len(raw)])).buckets(4, 10)])
            assert Counter(found.tolist()) == Counter(brute_grams(text, 4, 10))
        return
    model = language_id.fit(docs.filter("doc_id % 3 <> 0"), longest=3, bits=10)
    got = {(r.doc_id, r.text): (r.lang_pred, round(r.score, 4)) for r in language_id.predict(docs, model).collect()}
    want = brute_languages([(t, lang) for k, t, lang in rows if k is not None and k % 3], [t for _, t, _ in rows], 3, 10)
    assert got == {(k, t): (lang, round(score, 4)) for (k, t, _), (lang, score) in zip(rows, want)}
    assert model.languages == ["vv", "ww", "xx", "yy", "zz"]


def test_language_id_of_nothing(ready, messy, nothing):
    model = language_id.fit(nothing)
    assert {(r.lang_pred, r.score) for r in language_id.predict(messy, model).collect()} == {("und", 0.0)}
    assert language_id.predict(nothing, language_id.fit(messy)).count() == 0
    assert language_id.predict(messy, language_id.fit(messy)).columns == [*(c for c in messy.columns if c != "score"), "lang_pred", "score"]


def test_held_out_languages_are_found(ready, folder):
    docs = ready.read.parquet(f"{folder}/documents.parquet").collect()
    held = [r for r in docs if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    model = language_id.fit(ready.createDataFrame([r for r in docs if r not in held]))
    got = language_id.predict(ready.createDataFrame(held), model, keep=["lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)


def test_policies_keep_their_meaning_and_long_lines_are_told_apart(ready):
    """Versions are fixed sets of rules; strings whose polynomial hashes agree are different lines."""
    word = ["a"]
    for _ in range(10):  # the Thue-Morse word and its complement
        word += ["b" if c == "a" else "a" for c in word]
    one = "".join(word)
    two = one.translate(str.maketrans("ab", "ba"))
    few = "\n".join(["same line here"] * 2 + [f"w{i} x{i} y{i} z{i}" for i in range(4)])
    docs = ready.createDataFrame([(1, f"{one}\n{two}"), (2, f"{one}\n{one}"), (3, few)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in quality_rules.ledger(docs).collect()}
    assert [found[k].n_dup_lines for k in (1, 2, 3)] == [0, 1, 1]
    three = "\n".join(["same line here"] * 2 + [" ".join(f"w{i}" for i in range(16))])
    lines = ready.createDataFrame([(1, three)], "doc_id bigint, text string")
    kept = {v: quality_rules.kept_documents(lines, quality_rules.POLICIES[v]).count() for v in ("2024-1", "2024-2", "2024-3")}
    # one of three lines is repeated: too many for the older versions, too few for the newest
    assert kept == {"2024-1": 0, "2024-2": 0, "2024-3": 1}
