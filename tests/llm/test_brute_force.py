"""Operators that SQL cannot express against plain re-statements of their rules."""

import collections
import math
import random

import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from civitas.llm import decontamination as D, secret_scan as S
from test_llm import exact_truth, similar_truth

RUN = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def naive_spans(text):
    """The base rules, character by character."""
    out = []

    def assignment(i):
        """End of an assignment that begins at i, and how long its value is; None if there is none."""
        low = text.lower()
        for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
            if low.startswith(word, i) and text[i : i + len(word)].isascii():
                at = i + len(word)
                for quoted in (1, 0):
                    j = at + quoted
                    if quoted and text[at : at + 1] not in ('"', "'"):
                        continue
                    while text[j : j + 1] == " ":
                        j += 1
                    if text[j : j + 1] not in (":", "=") or j >= len(text):
                        continue
                    j += 1
                    while text[j : j + 1] == " ":
                        j += 1
                    if text[j : j + 1] in ('"', "'") and text[j + 1 : j + 2] and text[j + 1] in RUN:
                        j += 1
                    k = j
                    while k < len(text) and text[k] in RUN:
                        k += 1
                    if k > j:
                        return k, k - j
        return None

    i = 0
    while i < len(text):
        found = assignment(i)
        if found:
            if found[1] >= 6:
                out.append((i, 0, found[0]))
            i = found[0]
        else:
            i += 1
    for kind, start, letters, least in ((1, "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20), (2, "", set("0123456789abcdef"), 24)):
        i = 0
        while i < len(text):
            j = i + len(start)
            while text.startswith(start, i) and j < len(text) and text[j] in letters:
                j += 1
            if text.startswith(start, i) and j > i + len(start):
                if j - i >= least:
                    out.append((i, kind, j))
                i = j
            else:
                i += 1
    return sorted(out)


def test_base_spans_against_a_naive_scan():
    rng = random.Random(7)
    pieces = ["password", "Passwd", "SECRET", "token", "api_key", "ApiKey", "apikey", ":", "=", "==", "'", '"', " ", "  ", "\t", "é", "AKIA", "AKIAAKIA", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "deadbeef", "x", "hunter22", "/+.", "\n", "ſecret", "toKen"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))
        assert S.base_spans(text) == naive_spans(text), text


def test_learned_spans_recall_and_precision():
    """Credentials of every format inside assignments, addresses and quotes, and texts without any."""
    automata = S.train(S.examples())
    held, rng = S.examples(25, seed=123), random.Random(5)
    frames = ("put {} there", 'x="{}"', "key={} ok", "https://e.org/a?tok={}&b=1", "({})", "HEAD:{}\n", "path/{}")
    hits = collections.Counter()
    for kind, key in held:
        for f in frames:
            text = f.format(key)
            at = text.index(key)
            spans = S.base_spans(text)
            spans += S.learned_spans(text, automata, spans)
            hits[kind] += any(s < at + len(key) and at < e for s, _, e in spans)
    assert min(hits[k] for k in S.FORMATS) >= 0.9 * 25 * len(frames), hits
    words = ["the", "sea-side", "https://example.org/some/long/path/index.html", "2024-01-01T10:00:00", "snake_case_name_of_a_function", "CamelCaseNameOfAClass", "1,234,567.89", "e.g.", "src/main/java/Main.java"]
    false = sum(len(S.learned_spans(t, automata, S.base_spans(t))) for t in (" ".join(rng.choice(words) for _ in range(40)) for _ in range(300)))
    assert false == 0


def template(text, name=D.NAME):
    out = (text or "").translate({ord(c): " " for c in D.OWN})
    out = regex.sub(name, D.HOLD["name"], out)
    out = regex.sub(D.NUMBER, f" {D.HOLD['number']} ", out)
    out = regex.sub(f"(?i)(?<={D.HOLD['number']} {{1,2}})(?:{D.UNITS})(?![\\p{{L}}\\p{{N}}])", D.HOLD["unit"], out)
    return [w for w in regex.split(rf"[^\p{{L}}\p{{N}}{D.OWN}]+", out.lower()) if w]


def plain(text):
    return regex.findall(rf"{D.NUMBER}|\p{{L}}+", (text or "").lower())


def values(text):
    return [v.lower() for v in regex.findall(rf"{D.NAME}|{D.NUMBER}|(?<=\p{{N}} {{0,1}})(?i:{D.UNITS})(?![\p{{L}}\p{{N}}])", text or "")]


def leaks(docs, items, window=D.WINDOW, enough=D.ENOUGH):
    """(doc_id, item_id) -> kind, by sliding every item over every document."""
    held = set(D.HOLD.values())
    free = lambda ws: sum(w not in held for w in ws)
    first = {}
    for i, t in sorted(items):
        first.setdefault((tuple(template(t)), tuple(values(t))), (i, t))
    out = {}
    for d, text in docs:
        words = {"template": template(text), "words": plain(text)}
        theirs = values(text)
        slots = [k for k, w in enumerate(words["template"]) if w in held]
        for item, t in first.values():
            own, inner, found = template(t), template(t, D.INNER), []
            good = len(own) >= window and any(free(inner[i : i + window]) >= D.LITERAL for i in range(len(own) - window + 1))
            whole = len(own) if free(own) >= (1 if len(own) >= window else D.SHORT_LITERAL) else 0
            sizes = {"words": min(len(plain(t)), window) if len(plain(t)) >= D.SHORT else 0, "template": window if good else whole}
            for form, n in sizes.items():
                mine, them = (own if form == "template" else plain(t)), words[form]
                if not n:
                    continue
                places = [i for i in range(len(mine) - n + 1) if form == "words" or len(mine) == n or free(inner[i : i + n]) >= D.LITERAL]
                need = min(math.ceil(len(places) / 2), enough)
                for shift in range(-len(mine), len(them) + 1):
                    hit = [i for i in places if 0 <= i + shift <= len(them) - n and mine[i : i + n] == them[i + shift : i + shift + n]]
                    if not hit or len(hit) < need:
                        continue
                    pairs = []
                    if form == "template":
                        pairs = [(values(t)[k], theirs[slots.index(at + shift)]) for k, at in enumerate(i for i, w in enumerate(own) if w in held) if min(hit) <= at < max(hit) + n and at + shift in slots]
                    each = collections.defaultdict(set)
                    for a, b in pairs:
                        each[a].add(b)
                    sure = sum(free(mine[i : i + n]) == n for i in hit)
                    if max(map(len, each.values()), default=1) <= 1 or sure >= need:
                        found.append((len(hit), all(a == b for a, b in pairs)))
            if found:
                out[d, item] = "verbatim" if max(found)[1] else "reparameterised"
    return out


def test_decontamination_against_sliding_every_item(spark):
    rng = random.Random(11)
    names, units = ["Tom", "Anna", "Rose", "Jim"], ["kg", "miles", "euros"]
    verbs = ["has", "buys", "sells", "takes", "finds"]

    def question(n):
        a, b = rng.sample(names, 2)
        return " ".join(rng.choice([f"{a} {rng.choice(verbs)} {rng.randint(2, 30)} {rng.choice(units)} of red sand.", f"then {b} gives {a} half of the {rng.randint(2, 9)} bags,", "how many are left now?", f"the cost is {rng.randint(2, 99)} {rng.choice(units)}"]) for _ in range(n))

    items = [(i, question(rng.randint(1, 5))) for i in range(25)] + [(50, None), (51, ""), (52, "Who won?"), (53, "1 2 3 4 5 6 7 8 9")]
    swap = lambda t: t.replace("Tom", "Eve").replace("Anna", "Bob")
    docs = []
    for i in range(60):
        t = rng.choice(items[:25])[1]
        docs.append((i, rng.choice([t, t.upper(), swap(t), swap(t).replace("2", "7"), t.replace("Tom", "Ann", 1), question(2)]) + rng.choice(["", " And so on, it went.", "\nEnd"])))
    docs += [(100, None), (101, "")]
    got = D.leaks(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.kind for r in got} == leaks(docs, items)


def test_copies_of_the_pipeline_against_brute_force(spark):
    rng = random.Random(13)
    words = ["".join(rng.choice("abcdef") for _ in range(4)) for _ in range(200)]
    rows = []
    for i in range(25):
        own = [rng.choice(words) for _ in range(rng.choice([3, 8, 20, 60]))]
        for _ in range(4):
            w = list(own)
            if rng.random() < 0.6:
                w[rng.choice([0, -1])] = rng.choice(words)
            rows.append((len(rows), rng.choice([" ", "  "]).join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    exact = corpus_pipeline.exact_copies(spark, docs, "")
    kept = {r[0] for r in exact_truth(rows) if r[3]}
    assert {r.doc_id for r in exact.collect()} == kept
    left = [r for r in rows if r[0] in kept]
    near = corpus_pipeline.near_copies(spark, spark.createDataFrame(left, docs.schema), "")
    assert {r.doc_id for r in near.collect()} == {i for i, _, root, _ in similar_truth(left) if i == root}
    packed = corpus_pipeline.packed(spark, near, "").agg(F.sum("length").alias("n"), F.countDistinct("doc_id").alias("d")).first()
    assert packed.d == near.count() and packed.n == sum(r[0] for r in corpus_pipeline.packed(spark, near, "").groupBy("doc_id").agg(F.max("doc_tokens")).select("max(doc_tokens)").collect())


if __name__ == "__main__":
    pytest.main([__file__])


def test_learned_spans_are_precise_and_complete():
    """Credentials by their documented alphabets against encoded data, addresses, digests and identifiers, both made by other rules than the training's."""
    import base64
    import hashlib
    import string

    rng, automata = random.Random(77), S.train(S.examples())
    pattern, letters = S.candidates(automata), string.ascii_letters + string.digits
    made = lambda n, of=letters: "".join(rng.choices(of, k=n))
    raw = lambda n: rng.randbytes(n)
    words = ["get", "max", "Value", "HTTP", "index", "Parser", "config", "BUFFER", "size2"]
    harmless = {
        "base64": lambda: base64.b64encode(raw(rng.randint(30, 400))).decode(),
        "integrity": lambda: "sha512-" + base64.b64encode(hashlib.sha512(raw(9)).digest()).decode(),
        "digest": lambda: base64.b64encode(hashlib.sha256(raw(9)).digest()).decode(),
        "path": lambda: "https://store.example.com/" + "/".join(made(rng.choice([8, 22, 40, 43])) for _ in range(3)),
        "query": lambda: "https://x.example.com/a?id=" + made(rng.choice([11, 22, 36])),
        "uuid": lambda: "-".join(made(n, "0123456789abcdef") for n in (8, 4, 4, 4, 12)),
        "name": lambda: "_".join(rng.choice(words) for _ in range(6)),
        "camel": lambda: "".join(rng.choice(words).title() for _ in range(8)),
    }
    secret = {"github": lambda: "ghp_" + made(36), "npm": lambda: "npm_" + made(36), "google": lambda: "AIza" + made(35, letters + "_-"), "aws_secret": lambda: made(40, letters + "+/")}
    found = lambda text: bool(S.learned_spans(text, automata, S.base_spans(text), pattern))
    false = {k: sum(found(f"see {f()} there") for _ in range(150)) for k, f in harmless.items()}
    true = {(k, form): sum(found(form.format(f())) for _ in range(150)) for k, f in secret.items() for form in ("the {} of", "SOME_KEY={}")}
    assert max(false.values()) <= 6 and min(true.values()) >= 135
    assert sum(true.values()) >= 0.9 * (sum(true.values()) + sum(false.values()))
