"""The training-data operators against brute force, exact round trips and planted cases."""

import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from civitas.llm import chat, decontamination, exact_dedup, language_id, licenses, ngram_join, packing, quality, secret_scan, suffix_dedup

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, short, empty, null, repeated and white-space texts."""
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (3, 5, 9, 10, 12, 14, 20, 30, 60, 120)]
    rows, k = [], 0
    for b in base:
        for _ in range(6):
            w = b.split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                w[rng.choice([0, len(w) - 1, len(w) // 2])] = rng.choice(vocabulary)
            rows.append((k, " ".join(w)))
            k += 1
    rows += [(k, None), (k + 1, ""), (k + 2, " \t\n"), (k + 3, "One"), (k + 4, "one"), (k + 5, rows[0][1].replace(" ", "\n ")), (k + 6, "é" * 9000), (k + 7, "é" * 9000 + " "), (k + 8, "z" * 4096), (k + 9, "z" * 4097)]
    return rows


def with_clashes(df):
    """Extra columns of names that operators use inside."""
    return df.withColumns({c: F.lit(1) for c in ("name", "n", "cid", "uid", "block", "words", "at", "rank", "label", "part")})


def exact_truth(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, t in rows}
    points = {i: len(t or "") for i, t in rows}
    groups = collections.defaultdict(list)
    for i, x in norm.items():
        groups[x].append(i)
    best = {x: min(g, key=lambda i: (-points[i], i)) for x, g in groups.items()}
    return {(i, best[x], len(groups[x]), best[x] == i, hashlib.sha256(x.encode()).hexdigest()) for i, x in norm.items()}


@pytest.mark.parametrize("clash", [False, True])
def test_exact_dedup(spark, corpus, clash):
    # with three routing keys for all blocks, clashes are the rule
    route = (lambda b: F.pmod(F.xxhash64(b), F.lit(3))) if clash else F.xxhash64
    got = exact_dedup.exact_dedup(spark, with_clashes(frame(spark, corpus)), block=16, route=route).collect()
    assert {tuple(r) for r in got} == exact_truth(corpus) and len(got) == len(corpus)


def test_exact_dedup_edges(spark):
    assert exact_dedup.exact_dedup(spark, frame(spark, [])).collect() == []
    twice = exact_dedup.exact_dedup(spark, frame(spark, [(1, "a b"), (1, "a b"), (2, "ab")])).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in twice) == [(1, 1, 3, True), (1, 1, 3, True), (2, 1, 3, False)]


def test_exact_dedup_of_null_ids(spark):
    got = exact_dedup.exact_dedup(spark, frame(spark, [(None, "a"), (None, "a b"), (3, "ab")])).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=repr) == sorted([(None, None, 1, True), (None, None, 2, True), (3, None, 2, False)], key=repr)


def similar_truth(rows):
    def shingles(t):
        w = WORDS.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}
    links = collections.Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
                links.update((a, b))
    return {(i, len(sets[i]), find(i), links[i]) for i in ids}


@pytest.fixture(scope="module")
def near(corpus):
    """A chain of ever further copies of one text besides, in which most pairs are no links."""
    rng = random.Random(12)
    words, rows = [f"w{i}" for i in range(90)], []
    for i in range(70):
        if i % 4 == 0:
            words = [*words]
            words[rng.randrange(90)] = f"x{i}"
        own = words[:-1] + [f"end{i}"] if i % 3 else words
        rows.append((5000 + i, " ".join(own)))
    short = [" ".join(rng.choice("abc") for _ in range(rng.randint(5, 12))) for _ in range(80)]
    return corpus + rows + [(6000 + i, t) for i, t in enumerate(short)]


# as it is; in small blocks; without clusters, so that all pairs are candidates; both light and heavy sets at every size
@pytest.mark.parametrize("change", [{}, {"BLOCK_SETS": 4, "COLUMNS": 16}, {"LEAST": 9.0}, {"LIGHT_MOST": 0}, {"POSTING_COST": 10**9}, {"GATHERED": 50, "HELD": 40, "REMEMBERED": 2}])
def test_similar_groups(spark, near, monkeypatch, change):
    for k, v in change.items():
        monkeypatch.setattr(ngram_join, k, v)
    got = ngram_join.similar_groups(spark, with_clashes(frame(spark, near)).repartition(3)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got} == similar_truth(near) and len(got) == len(near)


def test_similar_groups_of_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (None, text + " more"), (None, "other words of no one else"), (4, None), (4, "")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in ngram_join.similar_groups(spark, frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, 36, None, 2), (1, 36, None, 2), (None, 37, None, 2), (None, 2, None, 0), (4, 0, 4, 0), (4, 0, 4, 0)], key=repr)


def test_overlaps_against_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 300))).astype(np.uint64) for _ in range(40)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    got = ngram_join.overlaps(sets)
    off = ~np.eye(40, dtype=bool)
    assert np.array_equal(got[off], want[off]) and np.array_equal(ngram_join.overlaps(sets[:15], sets[15:]), want[:15, 15:])


def test_similar_groups_empty_table(spark):
    assert ngram_join.similar_groups(spark, frame(spark, [])).collect() == []


def test_boundary_prefers_the_cheaper_side():
    assert ngram_join.boundary({}) == ngram_join.LIGHT_MOST
    assert 0 < ngram_join.boundary({s: 100 for s in range(1, 60)}) < ngram_join.LIGHT_MOST


def test_long_text_in_parts_gives_the_same_words():
    data = np.frombuffer(("alpha beta  gamma\n" * 300_000).encode(), np.uint8)
    bounds = np.array([0, len(data)])
    assert np.array_equal(ngram_join.words(data, bounds)[0], ngram_join._words(data, bounds)[0])


def test_decontamination(spark):
    item = "Yesterday Tom bought 5 apples and then Tom gave Anna 7 apples so how many apples are left for Tom now?"
    bench = frame(spark, [(1, item), (2, item), (3, "too short"), (4, None), (5, "")], "item_id long, text string")
    docs = frame(
        spark,
        [(1, "Well. Yesterday Jim bought 9 apples and then Jim gave Rose 12 apples so how many apples are left for Jim now? ok"), (2, "Yesterday Jim bought 9 apples and then Bob gave Rose 12 apples so how many apples are left for Eve now?"),
         (3, "x " + item.upper()), (4, None), (5, ""), (6, "Nothing of the kind was said here, at any time, by any one of us."), (7, item), (7, item)],
    )
    got = {(r.doc_id, r.item_id): r.kind for r in decontamination.leaks(spark, with_clashes(docs), bench).collect()}
    assert got == {(1, 1): "reparameterised", (3, 1): "verbatim", (7, 1): "verbatim"}
    assert decontamination.leaks(spark, docs.limit(0), bench).collect() == [] and decontamination.leaks(spark, docs, bench.limit(0)).collect() == []


def test_decontamination_plain_prose_in_any_case(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    items = [(i, " ".join(rng.choice(words) for _ in range(n)) + ".") for i, n in enumerate((8, 12, 30, 60))]
    clean = [(100 + i, " ".join(rng.choice(words) for _ in range(200))) for i in range(30)]
    leaked = [(i, f"{clean[i][1]}\n{(t.upper() if i % 2 else t)} {clean[i + 1][1]}") for i, t in items]
    got = decontamination.leaks(spark, frame(spark, clean + leaked), frame(spark, items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, i) for i, _ in items}


def test_decontamination_names_anywhere_and_items_without_windows(spark):
    tom = "Tom has 5 apples. Tom buys 3 more apples at the shop. Tom eats 2 of them. How many apples does Tom have now?"
    heavy = "Compute 12 + 7 - 3 + 44 + 9 - 21 + 6 * 8 - 31 + 17 + 5 - 2 + 63 - 11 + 14 + 90 - 4 + 38 + 27"
    bench = frame(spark, [(1, tom), (2, "Who wrote the play Hamlet in 1601?"), (3, heavy), (4, "too short"), (5, "Is Rome large?")], "item_id long, text string")
    other = tom.replace("Tom", "Anna").replace("5", "8").replace("3", "6").replace("2", "4")
    docs = [(1, f"Well.\n{other} ok"), (2, f"so {tom.upper()} ok"), (3, f"so {tom.lower()} ok"), (4, f"as: who wrote the play hamlet in 1601? {heavy.lower()}"), (5, 'He said "Who wrote the play Macbeth in 1606?"'),
            (6, heavy.replace("12", "13").replace("44", "45")), (7, other.replace("does Anna", "does Eve")), (8, "That is too short, and 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20"), (9, "IS ROME LARGE")]
    got = {(r.doc_id, r.item_id): r.kind for r in decontamination.leaks(spark, frame(spark, docs), bench).collect()}
    same, other = "verbatim", "reparameterised"
    assert got == {(1, 1): other, (2, 1): same, (3, 1): same, (4, 2): same, (4, 3): same, (5, 2): other, (6, 3): same, (9, 5): same}
    assert {tuple(r) for r in decontamination.unsearched(bench).collect()} == {(3, True, False), (4, False, False), (5, True, False)}


CHAT = "conv_id long, turn long, role string, text string"


def test_chat_round_trip(spark):
    hard = [r"\### Assistant: </turn> ok", "####### \\", "</turn", "<\\/turn>\n", "", None, "a\\\\</turn>\n### User: x", "\\c:"]
    rows = [(1, i, ("user", "assistant", "system", "tool:x\\c", None)[i % 5], t) for i, t in enumerate(hard)] + [(2, 0, "user", "only")] + [(3, 0, "assistant", "a"), (3, 1, "assistant", "b")] + [(4, 1, "user", "q"), (4, 1, "user", "q")]
    examples = chat.format_chat(with_clashes(frame(spark, rows, CHAT)))
    back = examples.where("last").select("conv_id", chat.turns_of(F.col("formatted")).alias("t")).collect()
    assert {r.conv_id: [(x.role, x.text) for x in r.t] for r in back} == {
        k: [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == k), key=lambda r: r[1])] for k in (1, 2, 3, 4)
    }
    for e in examples.collect():
        assert e.formatted.count("### ") == e.formatted.count("</turn>\n") == e.formatted.count("</turn>")
    loss = {r.conv_id: (r.n_turns, r.loss_chars, r.loss_sha256) for r in chat.digest(examples).collect()}
    for k in (1, 2, 3, 4):
        text = "".join(r[3] or "" for r in rows if r[0] == k and r[2] == "assistant")
        assert loss[k] == (sum(r[0] == k for r in rows), len(text), hashlib.sha256(text.encode()).hexdigest())
    assert examples.where("conv_id = 3").count() == 2 and chat.format_chat(frame(spark, [], CHAT)).collect() == []


def test_chat_of_a_null_conversation(spark):
    rows = [(None, 0, "user", "q"), (None, 1, "assistant", "a" * 200_000), (None, 2, "assistant", "b")]
    got = chat.digest(chat.format_chat(frame(spark, rows, CHAT))).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in got] == [(None, 3, 200_001)]


def test_quality(spark):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice(["the", "sea", "is", "calm", "today", "and", "we", "walk"]) for _ in range(80))
    bad = lambda: " ".join(rng.choice(["BUY!!", "NOW$$$", "***", "###click", "%%%"]) for _ in range(80))
    rows = [(i, good() if i % 2 else bad()) for i in range(300)]
    labels = frame(spark, [(i, i % 2, 0) for i in range(300)] + [(1, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    docs = with_clashes(frame(spark, rows + [(900, None), (901, ""), (902, "x" * 3_000_000)]))
    got = {r.doc_id: r for r in quality.score(spark, docs, labels).collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].predicted == i % 2 for i in held]) > 0.95
    assert got[900].score == got[901].score and all(0 <= r.score <= 1 for r in got.values()) and len(got) == 303
    assert all(r.score == 0.5 for r in quality.score(spark, docs, labels.limit(0)).collect())
    assert quality.score(spark, docs.limit(0), labels).collect() == []


def test_features_are_of_characters():
    text = "é straße 日本語"
    data = np.frombuffer(text.encode(), np.uint8)
    points, bounds = quality.characters(data, np.array([0, 3, len(data)]))
    assert points.tolist() == [ord(c) for c in text] and bounds.tolist() == [0, 2, len(text)]
    # each word with its blanks has len + 2 - (n - 1) n-grams of n characters, and itself
    want = sum(sum(max(0, len(w) + 2 - n + 1) for n in quality.GRAMS) + 1 for w in text.split(" "))
    assert sum(len(f) for f, _ in quality._features(data, np.array([0, len(data)]))) == want


def test_quality_sample_ends_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 10)
    docs = frame(spark, [(i, "good words here" if i % 2 else "BAD!! BAD!!") for i in range(40)])
    labels = frame(spark, [(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    assert len(quality.score(spark, docs, labels).collect()) == 40


def test_language_gradients():
    net = language_id.Network.new(["a", "b", "c"])
    rng = np.random.default_rng(0)
    data, label, weight = rng.integers(97, 110, (12, 5)).astype(np.uint8), rng.integers(0, 3, 5), np.ones((12, 5), np.float32)
    _, grads = language_id.gradients(net, data, label, weight)
    for w, g in zip(net.weights, grads, strict=True):
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in w.shape)
            at = (at[0], int(data[0, 0]), at[2]) if w is net.inputs else at
            old = w[at]
            w[at] = old + 1e-2
            up = language_id.gradients(net, data, label, weight)[0]
            w[at] = old - 1e-2
            down = language_id.gradients(net, data, label, weight)[0]
            w[at] = old
            assert abs((up - down) / 2e-2 - g[at]) < 2e-3


def test_language(spark):
    rng = random.Random(3)
    words = {"xx": ["the", "and", "ing", "tion", "with"], "yy": ["der", "und", "sch", "ung", "ßen"]}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(60)), k) for i, k in enumerate(["xx", "yy"] * 60)]
    rows += [(900, None, "xx"), (901, "123 ...", "yy"), (902, "", None), (903, "und der " * 50_000, None), (904, "é", None)]
    docs = frame(spark, rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(spark, with_clashes(docs)).collect()}
    assert np.mean([got[r[0]].lang_pred == r[2] for r in rows[:120] if got[r[0]].held_out]) > 0.95
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (900, 901, 902)) and got[903].lang_pred == "yy" and got[904].lang_pred in words
    blind = language_id.identify(spark, docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in blind} == {"und"}
    assert language_id.identify(spark, docs.limit(0)).collect() == []


def removal_truth(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = collections.Counter()
    for k, b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]) if b else b""
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[k, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("repeat", [False, True])
def test_suffix_dedup(spark, repeat):
    rng = random.Random(3)
    base = ["".join(rng.choice("abé \n") for _ in range(300)) for _ in range(6)]
    rows = [(i, "".join(rng.choice(base)[rng.randint(0, 50) : rng.randint(60, 300)] for _ in range(rng.randint(0, 5)))) for i in range(120)]
    rows += [(i + 200, "".join(rng.choice("abcdefgh") for _ in range(400))) for i in range(40)] + [(900, None), (901, ""), (902, "a" * 1000), (903, "ab" * 300), (904, "x" * 40)]
    rows += rows[:3] if repeat else []
    got = suffix_dedup.remove_repeats(spark, with_clashes(frame(spark, rows)), 40).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == removal_truth(rows, 40)


def test_suffix_dedup_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark, frame(spark, [])).collect() == []


def test_merge_never_loses_order():
    rng = random.Random(4)
    strings = sorted("".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode() for _ in range(300))
    runs = [sorted(rng.sample(strings, 40)) for _ in range(5)] + [[]]
    coded = [suffix_dedup.decoded(suffix_dedup.front_coded([(s, b"", False) for s in r])) for r in runs if r] + [[]]
    out, last = [], b""
    for r, i, shared in suffix_dedup.merged([[x[:2] for x in c] for c in coded]):
        s = coded[r][i][1]
        assert shared == suffix_dedup.shared_bytes(last, s) or not out
        out.append(s)
        last = s
    assert out == sorted(s for r in runs for s in r)


def test_secret_scan(spark):
    key, token = "AKIA" + "A1B2" * 5, "0123456789abcdef" * 2
    git = "ghp_" + "Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8Qr9St0Uv1Wx2"
    rows = [(1, f"é PassWord: 'hunter22' and {key} end"), (2, f'token="{token}"'), (3, f"use {git} now"), (4, "secret = abc; api_key=12345; nothing"), (5, None), (6, ""), (7, "plain words only, " * 2000), (1, "x")]
    got = secret_scan.scan(with_clashes(frame(spark, rows)), secret_scan.train(secret_scan.examples())).collect()
    by = {(r.doc_id, r.n_assign, r.n_access, r.n_hex): r for r in got}
    first = f"assign:2:{2 + len(chr(39).join(['PassWord: ', 'hunter22']))},access:{rows[0][1].index('AKIA')}:{rows[0][1].index('AKIA') + len(key)}"
    assert by[1, 1, 1, 0].spans == first and by[1, 1, 1, 0].base_sha256 == hashlib.sha256(first.encode()).hexdigest()
    assert (2, 1, 0, 1) in by and by[2, 1, 0, 1].spans.startswith(f"assign:0:{len(rows[1][1]) - 1},hex:7:")
    assert by[3, 0, 0, 0].spans == f"learned:4:{4 + len(git)}" and by[4, 0, 0, 0].spans == "" and by[7, 0, 0, 0].n_learned == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert by[5, 0, 0, 0].base_sha256 == by[6, 0, 0, 0].base_sha256 == empty and len(got) == len(rows)
    assert secret_scan.scan(frame(spark, []), []).collect() == []


def test_automata_tell_formats_from_words():
    automata = secret_scan.train(secret_scan.examples())
    best = lambda x: max(a.ratio(x, secret_scan.BACKGROUND) for a in automata)
    held = secret_scan.examples(30, seed=99)
    assert np.mean([best(t) >= secret_scan.THRESHOLD for _, t in held]) > 0.95
    assert all(best(w) < secret_scan.THRESHOLD for w in ("internationalisation", "notwithstanding", "thisisaverylongwordindeedtoolong", "and-then-some-more-words", "4807614710343232", "THERHAOUSHEDANDENANOU", "////////////////////", "2024-01-01_00-00-00"))


def test_credentials_glued_to_keys_and_paths():
    automata = secret_scan.train(secret_scan.examples())
    found = lambda x, a=automata: [x[s:e] for s, _, e in secret_scan.learned_spans(x, a, secret_scan.base_spans(x))]
    stripe, github, aws = "sk_live_" + "a1B2c3D4e5F6g7H8i9J0k1L2", "ghp_" + "Ab1Cd2Ef3Gh4Ij5Kl6Mn7Op8Qr9St0Uv1Wx2", next(c for k, c in secret_scan.examples(1, seed=99) if k == "aws_secret")
    for before, key, after in (("STRIPE_KEY=", stripe, ""), ("GH_AUTH=", github, ".bak"), ("aws_secret_access_key=", aws, ""), ("/v1/", github, "/x_y"), ("x.y/", stripe, "_old")):
        assert any(key in f for f in found(f"put {before}{key}{after} there")), before
    assert key in found(f"AKIA{'A1B2' * 5}/{stripe}")[0]
    assert found("src/main/java/org/example/project/internal/handlers/RequestHandler.java") == [] and found("=/" * 200_000) == []
    short = secret_scan.train([("own", f"zq9_{i % 10}X{i % 7}k{i % 3}") for i in range(60)])
    assert found("a zq9_1X2k0 b", short) == ["zq9_1X2k0"]


def test_packing(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary())
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["don't", "Straße,", "x\x1cy", "***a1", "<|endoftext|>", "ΑΣ.", "hello", "l'été", "\xa0", "d\x00e"]) for _ in range(rng.choice([0, 1, 50, 700, 3000])))) for i in range(60)]
    rows += [(900, None), (901, ""), (902, " \n"), (5, rows[5][1])]
    # separators that Python takes for white space and the vocabulary does not, at every place
    rows += [(1000 + i, t) for i, t in enumerate(f"{a}{c}{b}" for c in "\x1c\x1d\x1e\x1f\x85" for a in ("", " ", "a", "\n", " a ") for b in ("", " ", "b.", "\t", " b"))]
    got = packing.pack(spark, with_clashes(frame(spark, rows))).collect()
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}
    whole, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        own = list(np.frombuffer(r.ids, "<u4"))
        assert own == ids[r.doc_id][r.start : r.start + r.length] and r.ids_crc32 == zlib.crc32(r.ids) and r.doc_tokens == len(ids[r.doc_id])
        whole[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, pieces in whole.items():
        assert sum(n for _, n in pieces) == len(ids[i]) * sum(x == i for x, _ in rows)
    assert set(whole) == {i for i, _ in rows}
    for pieces in sequences.values():
        ends = [0]
        for offset, length in sorted(pieces):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
    assert 1 - sum(r.length for r in got) / (2048 * len(sequences)) < 0.05
    assert packing.pack(spark, frame(spark, [])).collect() == []


def test_words_are_tokenised_once():
    encoder = packing.Encoder(packing.vocabulary())
    rng = random.Random(8)
    letters = [*"aÉßŸµª²¼9 \t\n'.,;:!?-_<|\xad\xa0\x85\x00\x1cİΣ\u0301世", "'s", "the ", "word, ", "...", "<|endoftext|>", "<|ENDOFTEXT|>"]
    texts = ["".join(rng.choice(letters[: rng.choice([21, len(letters)])]) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    texts += ["", " \n", "x" * 100 + ".", "ab, " * (packing.BATCH // 4 + 1)]
    for text, ids in zip(texts, encoder.many(texts), strict=True):
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == encoder(text) == np.array(want, encoder.kind).tobytes(), text[:50]
    assert encoder.many([]) == []
    # a word in other case, with marks, and in a later task's texts is the same piece
    made, make = [], encoder.pieces.make
    encoder.pieces.make = lambda piece: made.append(piece) or make(piece)
    encoder.many(["Zyxwword, zyxwword.", "ZYXWWORD!"])
    encoder.many(["zyxwword? Zyxwword;"])
    assert made.count("zyxwword") == 1 and not any(len(x) > 8 for x in made)


def test_frequent_words_stay_remembered():
    made = []
    words = packing.Remembered(lambda x: made.append(x) or x.encode(), 10)
    for i in range(1000):
        assert words["often"] == b"often" and words[f"w{i}"] == f"w{i}".encode()
        assert len(words) <= 10 and len(words.before) <= 10
    assert made.count("often") == 1 and words["y" * 100] == b"y" * 100 and "y" * 100 not in words


def test_plan_pads_little():
    rng = np.random.default_rng(0)
    lengths = np.minimum(rng.lognormal(6.3, 1.1, 200_000).astype(int) + 1, 2047)
    counts = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True), strict=True)}
    plan = packing.plan(counts)
    rank = np.concatenate([np.arange(v) for v in counts.values()])
    _, _, size, sequence, _ = plan.place(np.repeat(list(counts), list(counts.values())), rank)
    assert size.sum() == lengths.sum() and np.bincount(sequence, size).max() <= 2048 and np.bincount(sequence, size).min() > 0
    assert 1 - lengths.sum() / (2048 * (sequence.max() + 1)) < 0.03


def test_nnls():
    rng = np.random.default_rng(1)
    a = rng.random((20, 40))
    x = packing.nnls(a, a @ np.maximum(rng.normal(size=40), 0))
    assert (x >= 0).all() and np.abs(a.T @ (a @ x - a @ x)).max() < 1e-6


def test_licenses(spark):
    mit = "Copyright (c) 2020 Jane Doe\n\n" + licenses.MIT.replace(" ", "  ").upper()
    rows = [(1, mit), (2, "Some text.\nReleased under the MIT Licence!\nMore."), (3, "Not Released under the MIT License."), (4, None), (5, ""), (6, "..."), (7, licenses.APACHE_NOTICE), (2, "released UNDER the mit license")]
    got = {(r.doc_id, r.license, r.form, r.unit): (r.n_hits, r.first_line) for r in licenses.scan(spark, with_clashes(frame(spark, rows))).collect()}
    assert got == {(1, "MIT", "text", "text"): (1, 0), (2, "MIT", "notice", "line"): (2, 1), (2, "MIT", "notice", "text"): (1, 0), (7, "Apache-2.0", "notice", "text"): (1, 0)}
    assert licenses.scan(spark, frame(spark, [])).collect() == []
    more = [(1, "Copyright (c) 2020 Jane Q. Doe. Released under the MIT License."), (2, "Copyright 2020 Jane Doe. All rights reserved.\n" + licenses.BSD_2), (3, "word " * 300_000 + "\nReleased under the MIT License."), (4, "copyright 2020 " + "x" * 500)]
    found = {(r.doc_id, r.license, r.unit) for r in licenses.scan(spark, frame(spark, more)).collect()}
    assert found == {(1, "MIT", "line"), (1, "MIT", "text"), (2, "BSD-2-Clause", "text"), (3, "MIT", "line")}
    clash = spark.createDataFrame([(h, 3, n, "text") for h in [hashlib.sha256(b"abc").hexdigest()] for n in ("B", "A")], "digest string, size int, license string, form string")
    assert [(r.license, r.n_hits) for r in licenses.scan(spark, frame(spark, [(1, "x\nABC!\nabc")]), clash).collect()] == [("A", 2)]


@pytest.mark.skipif(not os.path.isdir("/usr/share/common-licenses"), reason="no license texts on this machine")
def test_long_licenses_by_digest(spark):
    folder = "/usr/share/common-licenses"
    rows = [(i, open(f"{folder}/{f}").read()) for i, f in enumerate(("GPL-3", "Apache-2.0", "MPL-2.0")) if os.path.isfile(f"{folder}/{f}")]
    found = {r.doc_id: r.license for r in licenses.scan(spark, frame(spark, rows)).collect() if r.form == "text"}
    assert found == {i: ("GPL-3.0", "Apache-2.0", "MPL-2.0")[i] for i, _ in rows}


def test_license_files_as_they_are_found(spark):
    """Files of common forms: holders without a year, rights on a line of their own, many authors, bullets, headings, comments, long lines."""
    L = licenses
    bullets = L.BSD_3.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
    files = {
        "BSD-3-Clause": [
            "Copyright (c) 2020, Jane Doe\nAll rights reserved.\n\n" + L.BSD_3,
            "BSD 3-Clause License\n\nCopyright (c) 2020, Jane Doe\n\nAll rights reserved.\n\n" + bullets,
            "Copyright 2020 The X Authors\n" + L.BSD_3.replace("the copyright holder nor", "Example Inc. nor"),
            "Copyright (c) The Regents. All rights reserved.\n" + L.BSD_3.replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "JANE DOE").replace("THE COPYRIGHT HOLDER OR CONTRIBUTORS", "JANE DOE").replace("the copyright holder nor", "Jane Doe nor"),
        ],
        "BSD-2-Clause": ["\n".join(f" * {x}" for x in ("Copyright (c) 2020 Jane Doe\n\n" + L.BSD_2).split("\n"))],
        "MIT": [
            "Copyright (c) Microsoft Corporation.\n\n" + L.MIT,
            "(The MIT License)\n\n" + "\n".join(f"Copyright (c) {2000 + i} Author A. B. {i} <a{i}@x.org>" for i in range(30)) + "\n\n" + L.MIT,
            "The MIT License (MIT)\n\nCopyright © 2020 " + "long name " * 60 + "\n\n" + L.MIT,
            "MIT License\nCopyright (c) 2015-present, J. R. R. Doe, Foo Co. Ltd. and contributors (https://x.org)\nAll Rights Reserved\n" + L.MIT,
        ],
    }
    rows = [(i, f) for i, f in enumerate(f for fs in files.values() for f in fs)]
    want = [name for name, fs in files.items() for _ in fs]
    got = licenses.scan(spark, frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.license, r.unit) for r in got) == [(i, n, "text") for i, n in enumerate(want)]
    plain = [(1, "All rights reserved."), (2, "Copyright (c) 2020 X.\nAll rights reserved.\nReleased under the MIT License."), (3, "copyright holders say:\nReleased under the MIT License."), (4, "copyright 2020 " + "a.b " * 20_000)]
    found = {(r.doc_id, r.license, r.unit, r.first_line) for r in licenses.scan(spark, frame(spark, plain)).collect()}
    assert found == {(1, "proprietary", "line", 1), (1, "proprietary", "text", 0), (2, "MIT", "line", 3), (2, "MIT", "text", 0), (3, "MIT", "line", 2)}


def test_decontamination_judges_rows(spark):
    """Repeated and null ids with different texts, repeated rows, names of other forms, a very long text."""
    item = "Yesterday Tom bought 5 apples and then Tom gave Anna 7 apples so how many apples are left for Tom now?"
    good = "Yesterday Jim bought 9 apples and then Jim gave Rose 12 apples so how many apples are left for Jim now?"
    bad = "Yesterday Jim bought 9 apples and then Bob gave Rose 12 apples so how many apples are left for Eve now?"
    irish = good.replace("Jim", "O'Neil").replace("Rose", "McKay")
    bench = frame(spark, [(1, item)], "item_id long, text string")
    docs = [(1, good), (1, bad), (1, bad + " More."), (2, bad), (2, "none"), (None, bad), (None, "none"), (3, irish), (4, good), (4, good), (5, "word " * 200_000 + item)]
    got = {(r.doc_id, r.item_id): (r.kind, r.n_slots) for r in decontamination.leaks(spark, frame(spark, docs), bench).collect()}
    one = decontamination.leaks(spark, frame(spark, [(4, good)]), bench).first().n_slots
    assert got == {(1, 1): ("reparameterised", one), (3, 1): ("reparameterised", one), (4, 1): ("reparameterised", one), (5, 1): ("verbatim", got[(5, 1)][1])}
    assert [tuple(r)[:2] for r in decontamination.leaks(spark, frame(spark, [(None, good), (None, bad)]), bench).collect()] == [(None, 1)]
