"""Quality rules, token counts, decontamination, mixing, HTML, toxicity and the language model against brute force."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bazar.llm import decontaminate, exchange, html_text, mixing, quality_rules, suffix_tree_lm, token_counts, toxicity
from bazar.llm.queries import VOCABULARY
from bazar.llm.text import flat

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measures(text):
    words, text = WORD.findall(text or ""), text or ""
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {i + j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), len(lines))


def test_ledger_is_brute_force(ready, messy, nothing):
    rng = random.Random(1)
    extra = [(100 + i, "\n".join(" ".join(rng.choice(["a", "bb", "#c", "é|"]) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 12)))) for i in range(60)]
    df = messy.select("doc_id", "text", "n_words").unionByName(ready.createDataFrame(extra, "doc_id bigint, text string").withColumn("n_words", F.lit(0)))
    got = quality_rules.ledger(df)
    assert Counter((r.text, *(r[m] for m in quality_rules.MEASURES)) for r in got.collect()) == Counter((r.text, *brute_measures(r.text)) for r in df.collect())
    bits = {r.text: r.failure_bits for r in got.collect()}
    assert bits[None] == bits[""] == 1
    kept = quality_rules.kept_documents(messy, quality_rules.POLICIES["base"])
    assert kept.columns == messy.columns
    want = [r.text for r in messy.collect() if not ((m := brute_measures(r.text))[0] < 20 or 100 * m[4] > 30 * m[0])]
    assert Counter(r.text for r in kept.collect()) == Counter(want)
    assert quality_rules.ledger(nothing).count() == 0


def test_ablation_is_brute_force(ready):
    rng = random.Random(2)
    data = [rng.randrange(64) for _ in range(500)]
    policies = dict(quality_rules.POLICIES, votes=quality_rules.Policy("votes", ["symbols"], ["too_few_words", "short_words", "long_words"], 2))

    def rejects(p, bits):
        return bool(bits & p.mask(p.rules)) or bool(p.votes) and (bits & p.mask(p.votes)).bit_count() >= p.at_least

    got = {(r.version, r.rule): (r.n_failed, r.n_only, r.n_rejected) for r in quality_rules.ablation(ready.createDataFrame([(b,) for b in data], "failure_bits bigint"), policies).collect()}
    for p in policies.values():
        for rule in {*p.rules, *p.votes}:
            bit = 1 << quality_rules.RULE_NAMES.index(rule)
            # without the rule: as if nobody failed it
            assert got[p.version, rule] == (sum(b & bit > 0 for b in data), sum(rejects(p, b) and not rejects(p, b & ~bit) for b in data), sum(rejects(p, b) for b in data))
    empty = quality_rules.ablation(ready.createDataFrame([], "failure_bits bigint")).collect()
    assert empty and all(r.n_failed == r.n_only == r.n_rejected == 0 for r in empty)


def test_token_counts_are_those_of_the_tokenizer(ready, messy, nothing, folder):
    import sentencepiece
    import tokenizers
    from tokenizers import models, normalizers, pre_tokenizers

    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    # byte pieces score below all others, so the literal text of one never wins
    least = min(model.get_score(i) for i in range(model.get_piece_size()))
    vocabulary = [(model.id_to_piece(i), least if model.is_byte(i) or i < 3 else model.get_score(i)) for i in range(model.get_piece_size())]
    exact = tokenizers.Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    exact.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    texts = [r.text for r in messy.collect()] + [r.text for r in ready.read.parquet(f"{folder}/documents.parquet").select("text").limit(60).collect()]
    texts += ["a  b   c ", " lead", "tab\there", "▁mark▁", "🙂🙂 x", "\u0000"]
    counter = token_counts.Counter(token_counts.Vocabulary.load(VOCABULARY))
    for text in texts:
        assert counter.count(text)[0] == (len(exact.encode(text).ids) if text else 0), text
    got = token_counts.count_tokens(messy, token_counts.Vocabulary.load(VOCABULARY))
    assert Counter((r.text, r.n_tokens) for r in got.collect()) == Counter((r.text, counter.count(r.text)[0]) for r in messy.collect())
    assert token_counts.count_tokens(nothing, token_counts.Vocabulary.load(VOCABULARY)).count() == 0


def test_token_ties_and_spanning_pieces():
    pieces = {"▁": -1.0, "a": -1.0, "b": -1.0, "ab": -2.0, "▁a": -2.0, "b▁a": -1.5, "ba": -2.0}
    counter = token_counts.Counter(token_counts.Vocabulary(tuple(pieces), tuple(pieces.values())))
    assert not counter.splits
    # all paths of a text, with the rule that the longest last piece wins a tie
    for text in ("ab", "ab ab", "a c b", "bababab", ""):
        marked = "▁" + text.replace(" ", "▁") if text else ""
        best = {0: (0.0, 0)}
        for end in range(1, len(marked) + 1):
            options = [(best[s][0] + pieces[marked[s:end]], end - s, best[s][1] + 1) for s in range(end) if marked[s:end] in pieces]
            if marked[end - 1] not in pieces:
                options.append((best[end - 1][0] - 12.0, 1, best[end - 1][1] + len(marked[end - 1].encode())))
            score, _, count = max(options)
            best[end] = (score, count)
        assert counter.count(text) == (best[len(marked)][1], best[len(marked)][0])


def brute_leaks(text, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, found = split(text), set(), set()
    for item, body in items:
        own = split(body)
        size = min(window, len(own))
        grams = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own and item is not None else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in grams:
                hit |= set(range(i, i + size))
                found.add(item)
    return len(words), sorted(hit), sorted(found)


def test_leaks_are_brute_force(ready, messy, nothing):
    items = [(1, "One two, three four five six seven eight nine ten eleven"), (2, "ALPHA beta"), (2, "zeta"), (3, None), (4, ""), (5, "日本"), (7, "one two three four five six seven eight nine ten eleven"), (None, "e")]
    benchmark = ready.createDataFrame(items, "item_id bigint, text string")
    expected = Counter((r.text, str(brute_leaks(r.text, items))) for r in messy.collect())
    for block_bytes in (1 << 20, 40):
        got = decontaminate.find_leaks(messy, benchmark, block_bytes=block_bytes).collect()
        assert Counter((r.text, str((r.n_words, r.hit_words, r["items"]))) for r in got) == expected
    clean = decontaminate.clean_documents(messy, benchmark)
    assert clean.columns == messy.columns
    assert Counter(r.text for r in clean.collect()) == Counter(r.text for r in messy.collect() if not brute_leaks(r.text, items)[1])
    cut = decontaminate.without_leaks(messy, benchmark)
    assert cut.columns == messy.columns and cut.count() == messy.count()
    # cutting the words of an item can bring the words around it together, but leaves none of those that were hit
    kept = Counter(len(re.findall(r"\w", r.text or "")) for r in cut.collect())
    assert kept != Counter(len(re.findall(r"\w", r.text or "")) for r in messy.collect())
    assert decontaminate.find_leaks(nothing, benchmark).count() == 0
    assert all(r.hit_words == [] for r in decontaminate.find_leaks(messy, benchmark.limit(0)).collect())


def test_one_period_is_pfair():
    for tickets in ({"a": 1, "b": 1, "c": 1}, {"a": 7, "b": 2, "c": 1}, {"a": 13, "b": 11, "c": 5, "d": 1}, {"a": 4}):
        period = sum(tickets.values())
        given = Counter()
        for slot, s in enumerate(mixing.one_period(tickets), 1):
            given[s] += 1
            assert all(abs(given[x] - slot * a / period) < 1 for x, a in tickets.items())
        assert given == tickets


def test_plan_places_every_block_once():
    rng = random.Random(3)
    for _ in range(30):
        blocks = {f"s{i}": rng.randint(0, 40) for i in range(rng.randint(1, 6))}
        tickets = {s: rng.randint(0, 9) for s in blocks}
        phases = mixing.plan(blocks, tickets)
        slots = [mixing.slot_of(phases, s, i) for s, n in blocks.items() for i in range(n)]
        assert sorted(slots) == list(range(len(slots)))
        for s, n in blocks.items():
            assert [mixing.slot_of(phases, s, i) for i in range(n)] == sorted(mixing.slot_of(phases, s, i) for i in range(n))


@pytest.mark.parametrize("tickets", [None, {"s0": 5, "s1": 2, None: 1}, {"s1": 3}])
def test_mixed_rows_follow_the_plan(ready, messy, nothing, tickets):
    rng = random.Random(4)
    rows = [(i, rng.choice(["s0", "s0", "s1", None])) for i in range(700)] + [(3, "s0"), (None, "s1"), (None, "s1")]
    got = mixing.mix_sources(ready.createDataFrame(rows, "doc_id bigint, source string"), tickets, block_rows=8).collect()
    assert sorted(r.position for r in got) == list(range(len(rows)))
    assert Counter((r.doc_id, r.source) for r in got) == Counter(rows)
    by_place = sorted(got, key=lambda r: r.position)
    assert [r.slot for r in by_place] == sorted(r.slot for r in got)
    sizes = Counter(s for _, s in rows)
    blocks = {"" if s is None else f"={s}": -(-n // 8) for s, n in sizes.items()}
    weights = mixing.tempered_tickets({("" if s is None else f"={s}"): n for s, n in sizes.items()}) if tickets is None else {("" if s is None else f"={s}"): a for s, a in tickets.items()}
    phases = mixing.plan(blocks, weights)
    assert all(r.slot == mixing.slot_of(phases, "" if r.source is None else f"={r.source}", r.block) for r in got)
    assert mixing.mix_sources(messy).count() == messy.count() and mixing.mix_sources(nothing).count() == 0


def brute_mix(order, tickets, block):
    """The source at every place of the mix, from the rows of each source, by walking rounds and slots one by one."""
    sizes = {s: len(rows) for s, rows in order.items()}
    weight = {s: sizes[s] ** 0.5 if tickets is None else tickets.get(s, 0) for s in sizes}
    holder = {s: f"{math.floor(math.log2(n) * 4) if tickets is None else weight[s]:06d}" for s, n in sizes.items()}
    streams, total = defaultdict(list), defaultdict(float)
    for h in sorted(set(holder.values())):
        members = sorted((s for s in sizes if holder[s] == h), key=lambda s: (-(-(-sizes[s] // block)), "" if s is None else f"={s}"))
        for turn in range(max(-(-sizes[s] // block) for s in members)):
            for s in members:
                streams[h] += [(s, r) for r in range(turn * block, min(sizes[s], (turn + 1) * block))]
        total[h] = sum(weight[s] for s in members)
    shares = {h: max(1, round(1024 * w / sum(total.values()))) for h, w in total.items()} if tickets is None else {h: int(w) for h, w in total.items() if w}
    blocks = {h: -(-len(rows) // block) for h, rows in streams.items()}
    phases = mixing.plan(blocks, shares)
    slots = sorted((mixing.slot_of(phases, h, i), h, i) for h, n in blocks.items() for i in range(n))
    return [place for _, h, i in slots for place in streams[h][i * block : (i + 1) * block]]


@pytest.mark.parametrize("given", [False, True])
def test_any_number_of_sources(ready, given):
    rng = random.Random(9)
    names = [None, "", *(f"s{i}" for i in range(400))]
    rows = [(i, names[i]) for i in range(len(names))] + [(1000 + i, names[min(len(names) - 1, int(rng.expovariate(0.02)))]) for i in range(5000)]
    rows += [(2000 + i, "s0") for i in range(2500)] + [(7, "s0"), (None, "s3"), (None, "s3")]
    tickets = {s: 1 + i % 3 for i, s in enumerate(names) if i % 7} if given else None
    got = mixing.mix_sources(ready.createDataFrame(rows, "doc_id bigint, source string").repartition(5), tickets, block_rows=4).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter(rows)
    by_place = sorted(got, key=lambda r: r.position)
    assert [r.position for r in by_place] == list(range(len(rows)))
    assert [r.slot for r in by_place] == sorted(r.slot for r in got)
    order, ranks = defaultdict(list), []
    for r in by_place:
        ranks.append((r.source, len(order[r.source])))
        order[r.source].append(r)
    assert ranks == brute_mix(order, tickets, 4)
    assert all(r.block == rank // 4 for r, (_, rank) in zip(by_place, ranks))
    # a source has its rows in the same order as where it is one of few
    few = mixing.mix_sources(ready.createDataFrame([r for r in rows if r[1] in ("s0", "s3")], "doc_id bigint, source string"), block_rows=4).collect()
    for s in ("s0", "s3"):
        assert [r.doc_id for r in sorted(few, key=lambda r: r.position) if r.source == s] == [r.doc_id for r in order[s]]


def test_too_many_different_tickets_are_refused(ready):
    rows = [(i, f"s{i}") for i in range(300)]
    with pytest.raises(ValueError, match="different numbers"):
        mixing.mix_sources(ready.createDataFrame(rows, "doc_id bigint, source string"), {f"s{i}": i + 1 for i in range(300)})


def test_leaf_blocks():
    page = "<html><head><title>T</title><style>p{}</style></head><body>top<!-- c --><p>a <b>b<br>c &amp; d<p>e&nbsp; f<ul><li>x<li>y</ul><script>var t='</p>'</script><textarea><p>no</textarea>z < 3<![CDATA[<q>]]></body>"
    assert [b.text for b in html_text.leaf_blocks(page)] == ["top", "a b c & d", "e f", "x", "y", "z < 3<q>"]
    assert html_text.leaf_blocks(None) == html_text.leaf_blocks("") == html_text.leaf_blocks("<div><p></p></div>") == []
    assert [b.text for b in html_text.leaf_blocks("<p>open <a href='x>y")] == ["open y"]
    assert [b.text for b in html_text.leaf_blocks("<p>open <a title='x>y' b")] == ["open"]


def test_viterbi_is_brute_force():
    rng = random.Random(5)
    for _ in range(40):
        field = html_text.Field({f: rng.uniform(-2, 2) for f in "abcd"}, [[rng.uniform(-1, 1) for _ in "01"] for _ in "01"], [rng.uniform(-1, 1) for _ in "01"])
        seen = [[rng.choice("abcd") for _ in range(2)] for _ in range(rng.randint(1, 7))]
        total = lambda y: field.first[y[0]] + sum(sum(field.weights[f] for f in fs) * v for fs, v in zip(seen, y)) + sum(field.moves[a][b] for a, b in zip(y, y[1:]))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=len(seen)), key=total)
        assert tuple(field.decode(seen)) == best


def test_pages_are_extracted(ready, folder):
    pages = ready.read.parquet(f"{folder}/pages.parquet")
    field = html_text.fit(pages)
    rows = [r.html for r in pages.collect()]
    for page in rows[:25]:
        blocks = html_text.leaf_blocks(page)
        want = "\n".join(b.text for b, y in zip(blocks, html_text.own_labels(blocks)) if y)
        assert html_text.main_text(page, field) == want
        # a page that does not label itself
        assert html_text.main_text(page.replace("article>", "div>"), field) == want
    other = "<body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><main><h1>Title here</h1><p>The first paragraph, with words. It goes on.<div class='comments'><p>A reader says hello, and more.</div></main><aside>Other</aside><form>Name <input></form><div class='cookie-notice'>We use cookies.</div><footer>(c) 2020</footer>"
    assert html_text.main_text(other, field) == "Title here\nThe first paragraph, with words. It goes on."
    odd = ready.createDataFrame([(1, None, "t"), (2, "", "t"), (3, rows[0], "t"), (3, rows[0], "t")], "page_id bigint, html string, text string")
    got = html_text.extract(odd, field)
    assert [(r.text, r.n_chars) for r in got.orderBy("page_id").collect()] == [("", 0), ("", 0)] + [(html_text.main_text(rows[0], field), len(html_text.main_text(rows[0], field)))] * 2
    assert html_text.extract(odd.limit(0), field).count() == 0 and html_text.fit(odd.limit(0)).weights["bias"] < 0


def toxic_texts(seed, n):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    texts, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 150))]
        if i % 3 == 0:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["Zorgon", "zorgons", "blixt"])
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_toxicity_holds_out(ready, messy, nothing):
    texts, labels = toxic_texts(6, 500)
    net = toxicity.train(texts, labels)
    again = toxicity.train(texts, labels, epochs=toxicity.EPOCHS)
    unseen, truth = toxic_texts(7, 200)
    scores = net.scores(*flat(pa.array(unseen)))
    assert np.array_equal(scores, again.scores(*flat(pa.array(unseen))))
    assert np.mean((scores >= 0.5) == np.array(truth)) > 0.95
    got = toxicity.score(messy, net).collect()
    assert all(0 <= r.score <= 1 for r in got) and len({r.score for r in got if not WORD.search(r.text or "")}) == 1
    assert toxicity.score(nothing, net).count() == 0
    # the most toxic window decides, wherever it stands
    clean = unseen[1]
    assert net.scores(*flat(pa.array([clean * 40 + " zorgon blixt zorgons"])))[0] > net.scores(*flat(pa.array([clean * 40])))[0]


def test_toxicity_gradients():
    texts, labels = toxic_texts(8, 12)
    words = toxicity.Words.of(*flat(pa.array(texts)))
    net = toxicity.Network.new(np.sort(words.hashes[:40]))
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rows, firsts, sizes = words.windows()
    steps = np.arange(sizes.max())[:, None]
    there = steps < sizes
    place = words.place[np.minimum(firsts + steps, len(words.place) - 1)]
    target, weight = np.array(labels)[rows], np.ones(len(rows))

    def loss():
        odds = net.run(net.gates(*net.inputs(words)), place, there)
        return np.mean(np.logaddexp(0, odds) - target * odds)

    slope = toxicity.gradients(net, words, *net.inputs(words), place, there, target, weight)
    rng = np.random.default_rng(1)
    for name in ("out", "query", "again_f", "again_b", "gate_f", "word_f", "char_b", "word", "bias"):
        w, g = net.weights[name].reshape(-1), np.asarray(slope[name]).reshape(-1)
        for i in rng.integers(0, len(w) - (toxicity.VECTOR if name == "word" else 0), 3):
            old, eps = w[i], 1e-2
            w[i] = old + eps
            up = loss()
            w[i] = old - eps
            down = loss()
            w[i] = old
            assert abs((up - down) / (2 * eps) - g[i]) < 2e-3 + 0.05 * abs(g[i]), name


def test_toxicity_learns_from_labels_of_documents(ready, nothing):
    texts, labels = toxic_texts(9, 300)
    docs = ready.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    marks = ready.createDataFrame(list(enumerate(labels)) + [(7, None), (9999, 1)], "doc_id bigint, toxic int")
    net = toxicity.fit(docs, marks)
    assert np.mean((net.scores(*flat(pa.array(texts))) >= 0.5) == np.array(labels)) > 0.9
    blank = toxicity.fit(nothing.select("doc_id", "text"), marks)
    assert 0 <= blank.scores(*flat(pa.array(["", "word"])))[0] <= 1


def brute_lm(rows):
    """base and score per row, from plain counts."""
    docs = [(k, [*WORD.findall(t or ""), None]) for k, t in rows]
    train = [t for k, t in docs if not suffix_tree_lm.held_out(k)]
    c = Counter(w for t in train for w in t)
    total, known = sum(c.values()), len(c)
    p0 = lambda w: (c[w] + 0.1) / (total + 0.1 * (known + 1))
    least, discount = {n: suffix_tree_lm.least_count(n, total) for n in (1, 2)}, suffix_tree_lm.DISCOUNT
    counts, after, kept = {1: Counter(), 2: Counter()}, Counter(), defaultdict(list)
    for t in train:
        for i in range(1, len(t)):
            for n in (1, 2):
                if i >= n:
                    s = tuple(t[i - n : i])
                    if all(c[w] >= least[n] for w in s):
                        after[s] += 1
                        if c[t[i]] >= least[n]:
                            counts[n][s, t[i]] += 1
    for n in (1, 2):
        for (s, w), k in counts[n].items():
            kept[s].append((w, k))
    after = Counter({s: n for s, n in after.items() if n >= suffix_tree_lm.LEAST_OCCURRENCES})
    share = {s: min(1.0, max(0.0, 1 - sum(k - discount for _, k in kept[s]) / n)) for s, n in after.items()}

    def prob(s, w, states):
        """P(w) in context s, backing off through ``states``."""
        if not s:
            return p0(w)
        lower = prob(s[1:], w, states)
        if s not in after or s not in states:
            return lower
        return max(counts[len(s)][s, w] - discount, 0) / after[s] + share[s] * lower

    everything = set(after)
    retained = set()
    for s, n in after.items():
        gain, mass = 0.0, 0
        for w, k in kept[s]:
            lower = prob(s[1:], w, everything)
            gain += k * math.log2((max(k - 1 - discount, 0) / max(n - 1, 1) + share[s] * lower) / lower)
            mass += k
        if gain + (n - mass) * math.log2(max(share[s], 1e-300)) >= suffix_tree_lm.GAIN:
            retained.add(s)
    out = []
    for k, t in docs:
        base = sum(math.log10(p0(w)) for w in t)
        best = sum(math.log10(prob(tuple(t[max(0, i - 2) : i]), t[i], retained)) for i in range(len(t)))
        out.append((len(t), sum(c[w] > 0 for w in t), total, base, best))
    return out, retained


def test_language_model_is_brute_force(ready, messy, nothing, monkeypatch):
    monkeypatch.setattr(exchange, "LEAST_CHUNK_BYTES", 2000)
    rng = random.Random(10)
    follow = {w: [rng.choice("abcdefghijkl") for _ in range(2)] for w in "abcdefghijkl"}
    rows = []
    for i in range(300):
        words = [rng.choice("abcdefghijkl")]
        for _ in range(rng.randint(0, 60)):
            words.append(rng.choice(follow[words[-1]]) if words[-1] in follow and rng.random() < 0.8 else rng.choice("abcdefghijklmnopqrstuvwxyz"))
        rows.append((i, " ".join(words)))
    rows += [(1000, None), (1001, ""), (1002, "never seen words"), (None, "a b c"), (5, rows[5][1])]
    expected, retained = brute_lm(rows)
    assert {len(s) for s in retained} >= {1}
    got = suffix_tree_lm.score(ready.createDataFrame(rows, "doc_id bigint, text string")).collect()
    found = sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got)
    assert found == sorted((n, k, t, round(b, 6), round(s, 6)) for n, k, t, b, s in expected)
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in got)
    odd = suffix_tree_lm.score(messy)
    assert odd.count() == messy.count() and set(odd.columns) == {*messy.columns, *(f.name for f in suffix_tree_lm.COLUMNS)}
    assert suffix_tree_lm.score(nothing).count() == 0


def test_language_model_lower_cases(ready):
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice(["the", "The", "THE", "cat", "Cat", "É", "é"]) for _ in range(30))) for i in range(60)]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    expected, _ = brute_lm([(k, t.translate(lower)) for k, t in rows])
    got = suffix_tree_lm.score(ready.createDataFrame(rows, "doc_id bigint, text string")).collect()
    found = sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got)
    assert found == sorted((n, k, t, round(b, 6), round(s, 6)) for n, k, t, b, s in expected)


def test_language_model_keeps_contexts_of_rare_words(ready):
    rng = random.Random(13)
    rows = [(i, " ".join(rng.choice("abcdefghijklmnopqrst") for _ in range(40))) for i in range(80)]
    rows += [(100 + i, f"a rare{i % 3} word{i % 3} thing b") for i in range(48)]
    expected, retained = brute_lm(rows)
    assert ("rare1",) in retained
    assert suffix_tree_lm.least_count(2, 10**10) == suffix_tree_lm.least_count(2, 100)
    got = suffix_tree_lm.score(ready.createDataFrame(rows, "doc_id bigint, text string")).collect()
    found = sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got)
    assert found == sorted((n, k, t, round(b, 6), round(s, 6)) for n, k, t, b, s in expected)
