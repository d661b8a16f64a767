"""Each operator on odd rows and on an empty table, against plain brute force."""

from __future__ import annotations

import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

from tidefunnel.llm import (
    bpe,
    fingerprints,
    gam,
    html_text,
    licenses,
    mixing,
    near_dedup,
    pii,
    queries,
    rules,
    sketch,
    token_files,
    words,
)

SMALL = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def plain_words(text):
    return re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()).split()


def plain_set(text):
    w = plain_words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


@pytest.mark.parametrize("block", [1 << 22, 1, 7, 23])
def test_word_numbers(block, monkeypatch):
    monkeypatch.setattr(words, "BLOCK", block)
    texts = ["", "a b c", "One  two\tthree four five six", "x", " a b c ", "A B C", "über straße", "w" * 50]
    found, begins = words.hash_words(*words.text_bytes(texts))
    want = [w for t in texts for w in plain_words(t)]
    assert list(np.diff(begins)) == [len(plain_words(t)) for t in texts]
    assert len(set(found.tolist())) == len(set(want)) == len(set(zip(want, found.tolist(), strict=True)))
    runs, at = words.shingles(found, begins)
    assert [len(set(runs[a:b].tolist())) for a, b in zip(at[:-1], at[1:], strict=True)] == [
        len(plain_set(t)) for t in texts
    ]


def test_sketches_estimate():
    rng = np.random.default_rng(1)
    for n in (1, 4, 300):
        core = rng.integers(0, 1 << 62, n * 3).astype(np.uint64)
        own = rng.integers(0, 1 << 62, (2, n)).astype(np.uint64)
        values = np.concatenate([core, own[0], core, own[1]])
        table = sketch.sketches(values, np.array([0, 4 * n, 8 * n]))
        assert (table != sketch.EMPTY).all()
        assert abs((table[0] == table[1]).mean() - 0.6) < 0.15


PRIVATE = {
    "write john.doe (at) example [dot] com now": "john.doe (at) example [dot] com",
    "john at example dot com": "john at example dot com",
    "+4 five five five one two three four five six seven x": "+4 five five five one two three four five six seven",
    "card four five three nine 1488 0343 6467 x": "four five three nine 1488 0343 6467",
    "mаil jоhn@exаmple.com": "jоhn@exаmple.com",
    "４５３９１４８８０３４３６４６７": "４５３９１４８８０３４３６４６７",
    "at 192 dot 168 dot 1 dot 20 now": "192 dot 168 dot 1 dot 20",
    "john@exa​mple.com": "john@exa​mple.com",
}


@pytest.mark.parametrize("text", PRIVATE)
def test_disguised_data(text):
    _, every = pii.find(text)
    assert PRIVATE[text] in [text[a:b] for _, a, b in every]
    assert PRIVATE[text] not in pii.redact(text, every)


BEHIND_PROSE = {
    "Contact me at john.smith (at) example (dot) com today": "john.smith (at) example (dot) com",
    "mail at jane.doe at example dot com": "jane.doe at example dot com",
    "us at john.smith [at] example.com": "john.smith [at] example.com",
    "me at john dot smith at example dot com": "john dot smith at example dot com",
    "we at acme.org say at once at jo.do @ x.org": "jo.do @ x.org",
    "was at a.b at c.d at e.f (at) g.org": "e.f (at) g.org",
}


HARDLY_DISGUISED = {
    "mail jane.doe at example.com.": ("email", "jane.doe at example.com"),
    "me at jane_doe at mail.example.org, or": ("email", "jane_doe at mail.example.org"),
    "call +44 7700 nine 00123 now": ("phone", "+44 7700 nine 00123"),
    "card 4539 1488 0343 646 seven x": ("card", "4539 1488 0343 646 seven"),
    "page one ４５３９１４８８０３４３６４６７": ("card", "４５３９１４８８０３４３６４６７"),
}


@pytest.mark.parametrize("text", HARDLY_DISGUISED)
def test_one_sign_of_a_disguise(text):
    base, every = pii.find(text)
    assert base == [] and [(k, text[a:b]) for k, a, b in every] == [HARDLY_DISGUISED[text]]


@pytest.mark.parametrize("text", ["me at john.smith", "seen jane.doe at home.Then", "well-known at example.com", "one 3"])
def test_signs_of_prose(text):
    assert pii.find(text) == ([], [])


@pytest.mark.parametrize("text", BEHIND_PROSE)
def test_addresses_behind_prose(text):
    base, every = pii.find(text)
    assert base == [] and [text[a:b] for _, a, b in every] == [BEHIND_PROSE[text]]
    assert pii.redact(text, every) == text.replace(BEHIND_PROSE[text], "[EMAIL]")


@pytest.mark.parametrize("text", ["the cat sat at home. dot one two", "user at mail.example.com", "one day at 3.5"])
def test_prose_is_not_private(text):
    assert pii.find(text) == ([], [])


def test_base_matches_are_the_patterns(spark):
    texts = [r.text for r in queries.table(spark, SMALL, "documents").collect()]
    texts += ["a@b@c.de..f.g", "x@y.z@w.q", "999.1.1.1 1.2.3.4.5", "@a.b", "+1 (2) 3"]
    for t in texts:
        want = [
            (k, *m.span()) for k in pii.KINDS for m in re.finditer(pii.PATTERNS[k], t) if pii._valid(k, m[0])
        ]
        assert pii.base_spans(t) == want


def test_pii_rows(spark, odd, nothing):
    got = {r.doc_id: r for r in pii.find_pii(odd).collect()}
    assert got[9].n_email == 1 and got[9].n_added == 1
    assert got[4].spans == "" and got[4].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find_pii(nothing).count() == 0
    clean = {r.doc_id: r for r in pii.without_pii(odd).collect()}
    assert "bob@x.co" not in clean[9].text and clean[4].text is None and clean[9].kept == 9


PAGE = (
    '<body class="has-ads"><header>Site</header><nav><a>Home</a></nav>{}<div id="comments">no</div>'
    "<footer>&copy; us</footer></body>"
)


def test_marked_regions():
    page = PAGE.format(
        "<article><h1>A &amp; B</h1><p>one <b>two</b>\n three<br>four<p>five<script>x='</p>'</script>"
        '<div class="ad">buy</div><p class="lead">six</article>'
    )
    assert [t for k, t in html_text.blocks(page) if k == "article"] == ["A & B", "one two three four", "five", "six"]
    assert html_text.blocks("") == [] and html_text.blocks("plain &lt; text") == [("open", "plain < text")]


def test_unmarked_boilerplate_goes_by_host(spark):
    wall = "<p>Subscribe to our letter for more of the same every single day</p>"
    rows = [
        (i, "http://h.org/%d" % i, "<body>" + wall + f"<p>own story number {i} with words of its own {i * 7}</p>")
        for i in range(5)
    ]
    rows += [(9, None, None), (10, "x", ""), (None, "http://h.org/n", "<article>a</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    assert got[3] == "own story number 3 with words of its own 21"
    assert got[9] == got[10] == "" and got[None] == "a"
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_runs_decide_beside_an_article(spark):
    wall = "<div>Subscribe to our letter for more of the same every single day</div>"
    page = (
        "<body>{}<div><p>first part {} of the story, number {} of its kind</p></div><article><h2>teaser {}</h2></article>"
        "<div>second part {} of it, with words {} of its own</div><div class='ad'>buy {}</div>{}</body>"
    )
    rows = [(i, f"http://h.org/{i}", page.format(wall, i, i * 7, i, i, i * 9, i, wall)) for i in range(5)]
    inside = "<article><p>own {}</p><section class='notice'><p>{}</p></section></article>"
    terms = "All terms that apply to every page of this host are found elsewhere"
    rows += [(10 + i, f"http://k.org/{i}", inside.format(i, terms)) for i in range(4)]
    rows += [(20, "http://k.org/u", inside.format(20, "Notice that only this article has, in a section of its own"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    for i in range(5):
        first = f"first part {i} of the story, number {i * 7} of its kind"
        assert got[i] == f"{first}\nteaser {i}\nsecond part {i} of it, with words {i * 9} of its own"
    assert [got[10 + i] for i in range(4)] == [f"own {i}" for i in range(4)]
    assert got[20] == "own 20\nNotice that only this article has, in a section of its own"


def test_names_are_evidence():
    page = (
        '<article><h2 class="notice">A notice</h2><section id="related-work"><p>doubt</p></section>'
        '<section id="comments">said</section><div class="share">share</div><h3 hidden>no</h3>end</article>'
    )
    kinds = [("article", "A notice"), ("open", "doubt"), ("named", "said"), ("named", "share"), ("chrome", "no")]
    assert html_text.blocks(page) == [*kinds, ("article", "end")]
    form = html_text.blocks('<form id="all"><nav>menu</nav><div>body of the page</div></form>')
    assert html_text.unique_blocks(*map(list, zip(*form, strict=True)), []) == ["body of the page"]
    assert html_text.blocks("<form><main>text</main>x</form>") == [("article", "text"), ("named", "x")]


def test_suffix_runs():
    streams = [list("abcdefgh"), list("xxabcdefyy"), list("ab"), []]
    page, place, rank = html_text.suffix_runs(streams, 6)
    names = {}
    for p, i, r in zip(page, place, rank, strict=True):
        names.setdefault(int(r), set()).add("".join(streams[p][i : i + 6]))
    assert all(len(x) == 1 for x in names.values())
    assert len(page) == 3 + 5 and len(names) == 7


def test_quality_model(spark, odd, nothing):
    rng = np.random.default_rng(2)
    x = rng.random((3000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no single feature tells
    model = gam.fit(x[:2000], y[:2000])
    assert (0, 1) in model.pairs or (1, 0) in model.pairs
    assert (((model.score(x[2000:]) >= 0.5) == y[2000:]).mean()) > 0.9
    docs, labels = (queries.table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    got = gam.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95
    none = labels.limit(0)
    assert {r.score for r in gam.quality_scores(odd, none).collect()} == {0.5}
    assert gam.quality_scores(nothing, labels).count() == 0


def near_by_hand(rows):
    sets = [(i, plain_set(t)) for i, t in rows]
    least = {i: i for i, _ in sets}
    for _ in sets:
        for i, a in sets:
            for j, b in sets:
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    least[i] = min(least[i], least[j])
    return least


def test_near_duplicates(spark, odd, nothing):
    got = near_dedup.near_duplicates(odd)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    least = near_by_hand([x for x in rows if x[0] is not None])
    for r in got.collect():
        assert r.component_id == least.get(r.doc_id) and r.kept == (r.component_id == r.doc_id or r.doc_id is None)
    assert got.count() == len(rows)
    assert near_dedup.near_duplicates(nothing).count() == 0
    stay = near_dedup.representatives(odd)
    assert stay.columns == odd.columns and {r.doc_id for r in stay.collect()} == {1, 4, 5, 6, 7, 9, None, 11, 12}


def test_texts_that_share_an_id(spark):
    """Each text of an id links it, in any order of the rows, and the id joins its texts."""

    def near(name, own=0):
        return " ".join([f"{name}{i}" for i in range(100)] + [f"{name}own{own}"])

    rows = [(2, near("a")), (2, near("b")), (2, near("c")), (3, near("a", 1)), (4, near("b", 1)), (5, near("c", 1))]
    rows += [(6, near("d")), (7, near("d")), (7, near("e")), (8, near("e", 1)), (9, near("f")), (10, near("g"))]
    want = {2: 2, 3: 2, 4: 2, 5: 2, 6: 6, 7: 6, 8: 6, 9: 9, 10: 10}
    for table in (rows, rows[::-1]):
        frame = spark.createDataFrame(table, "doc_id long, text string").coalesce(1)
        got = near_dedup.near_duplicates(frame).collect()
        assert len(got) == len(rows) and {(r.doc_id, r.component_id) for r in got} == set(want.items())


def test_chains_and_large_groups(spark):
    """A chain links its ends; a group larger than a block of sketches stays whole."""
    text = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(700):
        own = list(text)
        for j in range(3):
            own[(i * 7 + j * 41) % 120] = f"x{i}_{j}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + s, " ".join(f"c{k}" for k in range(8 * s, 8 * s + 100))) for s in range(12)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: plain_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert got == {i: find(i) for i in sets}


def test_token_files(spark, odd, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    start = 0
    got = token_files.token_files(odd, WORDS).orderBy("start").collect()
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    assert len(got) == len(rows)
    for g, r in zip(got, rows, strict=True):
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        assert (g.start, g.n_tokens, g.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_files.token_files(nothing, WORDS).count() == 0


@pytest.mark.parametrize(
    "text", ["", "don't we'll ''s THE.End 3.5 a--b ...", "H̱ é İstanbul", "<|endoftext|> x", "日本語 ½ ²", "ab'cd'll,'s"]
)
def test_words_one_by_one_are_the_text(text):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids
    assert token_files.word_encoder(WORDS, 2)(text) == np.array(ids, "<u2").tobytes()


def test_perfect_hash():
    keys = words.mix(np.arange(5000, dtype=np.uint64))
    index = token_files.Index.build(keys)
    assert sorted(index.slots(keys)) == list(range(5000))
    with pytest.raises(ValueError):
        token_files.Index.build(np.array([1, 1], np.uint64))


def test_fingerprints(spark, odd, nothing):
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    got = {}
    for r in fingerprints.document_fingerprints(odd).collect():
        got.setdefault(r.doc_id, []).append(r)
    for k, r in enumerate(rows):
        text, following = r.text or "", rows[(k + 1) % len(rows)].text or ""
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        own = [g for g in got[r.doc_id] if g.edited_sha256 == digest]
        assert own and own[0].n_chars == len(text)
        a, b = plain_set(text), plain_set(edited)
        if a and b:
            assert abs(own[0].near_edited - len(a & b) / len(a | b)) < 0.15
    assert got[1][0].fingerprint == got[2][0].fingerprint and got[4][0].fingerprint == ""
    assert fingerprints.document_fingerprints(nothing).count() == 0


def test_byte_bpe(spark, odd, nothing):
    encoding = bpe.load_encoding(RANKS, public_tokenizers.PATTERN)
    for r in odd.collect():
        text = r.text or ""
        parts = bpe.pieces(text, 40)
        assert "".join(parts) == text
        assert sum((encoding.encode_ordinary(p) for p in parts), []) == encoding.encode_ordinary(text)
    args = (RANKS, public_tokenizers.PATTERN)
    back = bpe.decode_documents(bpe.encode_documents(odd, *args), *args).collect()
    assert sorted(bytes(r.raw) for r in back) == sorted((r.text or "").encode() for r in odd.collect())
    assert bpe.round_trip(nothing, *args).count() == 0


def same(df, sql, documents):
    con = duckdb.connect()
    con.register("documents", documents)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in cur.fetchall())
    rows = df.select(*names).collect()
    got = sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in rows)
    assert got == want


@pytest.mark.parametrize(
    "run,sql",
    [
        (licenses.license_scan, licenses.license_sql()),
        (rules.quality_rules, rules.rules_sql()),
        (mixing.mixed, mixing.mixing_sql()),
    ],
    ids=["licenses", "rules", "mixing"],
)
def test_against_sql(spark, odd, nothing, run, sql):
    once = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    same(run(once), sql, once.toArrow())
    assert run(odd).count() == odd.count()
    assert run(nothing).count() == 0


WRAPPED = {
    "mit": "/* Permission is hereby granted, free of charge, to any person obtaining a copy\n"
    " * of this software and associated documentation files (the \"Software\"), to deal */",
    "apache-2": "# you may not use this file except in compliance with the License.\n"
    "# You may obtain a copy of the License at\n#\n#   http://x",
    "bsd": "Redistribution and use in source and binary forms, with or without\n"
    "modification, are permitted provided that the following conditions\nare met:",
    "gpl": "rem This program is free software: you can redistribute it and/or modify\n"
    "rem it under the terms of the GNU General Public License as published by",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any\r\n"
    "purpose with or without fee is hereby granted, provided",
}


def by_windows(text):
    """(label, containment) of every template in every run of words around its length."""
    words = re.findall("[a-z0-9]+", text.lower())
    out = {}
    for label, t in licenses.TEMPLATES:
        own, width = set(t.split()), int(1.5 * len(t.split()))
        best = max((len(own & set(words[i : i + width])) for i in range(len(words))), default=0)
        if best >= 0.93 * len(own) - 1e-9:
            out[label] = max(out.get(label, 0), best / len(own))
    return out


def test_notices_in_blocks_of_words(spark):
    texts = list(WRAPPED.values())
    texts += ["before it\n" * 40 + t + "\nbehind it" * 40 for t in texts]
    rng = np.random.default_rng(5)
    for _, t in licenses.TEMPLATES:
        words = t.split()
        texts.append(" ".join(words + ["other"] * 60))
        # all words of the template on one line, pages apart
        texts.append(" ".join(w + " filler" * 50 for w in words))
        for share in (0.3, 0.5, 0.7):  # about the widest block
            more = np.sort(rng.integers(0, len(words), int(share * len(words))))
            texts.append("\n".join(np.insert(np.array(words, object), more, "x")))
        texts.append(" ".join(rng.permutation(words)[1:]))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    same(licenses.license_scan(frame), licenses.license_sql(), frame.toArrow())
    got = {r.doc_id: r for r in licenses.license_scan(frame).collect()}
    assert len(got) == len(texts)
    for i, label in enumerate([*WRAPPED, *WRAPPED]):
        assert got[i].labels == label and got[i].score > 0.93
    for i, text in enumerate(texts):
        want = by_windows(text)
        base = set(got[i].base_labels.split(",")) - {""}
        assert set(got[i].labels.split(",")) - {""} == base | set(want), text
        if not base:
            assert got[i].score == pytest.approx(max(want.values(), default=0)), text
    scattered = [got[i] for i, t in enumerate(texts) if " filler filler" in t]
    assert len(scattered) == len(licenses.TEMPLATES) and not any(r.labels or r.score for r in scattered)


def test_cascade_order_does_not_change_the_verdict():
    texts = [b"", b"a " * 60, b"Some plain prose. " * 2, b"X!! " * 80, b"### " * 60, b" ".join(b"w%d" % i for i in range(80))]
    alone = rules.cascade(texts, list(rules.RULES))
    assert (alone == rules.cascade(texts, list(rules.RULES)[::-1])).all() and list(alone) == [False] * 5 + [True]
    assert {x[0] for x in rules.costs(texts)} == {r.name for r in rules.RULES}


def test_targets_are_met(spark):
    rows = [(s, l, t, n) for s, a in (("x", 9), ("y", 1)) for l, b in (("en", 5), ("de", 2)) for t, n in (("p", 100 * a * b), ("q", 30 * a * b))]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, n_tokens long")
    raked = mixing.rake(cells, budget=0.3).collect()
    total = 0.3 * sum(r.n_tokens for r in raked)
    for d in mixing.DIMENSIONS:
        want = {r[0]: r.share for r in mixing.default_targets(cells, d).collect()}
        for value, share in want.items():
            assert sum(r.weight for r in raked if r[d] == value) == pytest.approx(share * total, rel=1e-3)


def test_missed_targets_are_reported(spark):
    """At the registered budget a small topic is asked for more than it has."""
    rows = [("x", "en", "p", 9000), ("y", "en", "p", 8000), ("x", "en", "q", 100), ("y", "en", "q", 100)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, n_tokens long")
    lang = spark.createDataFrame([("en", 0.9), ("de", 0.1)], "lang string, share double")
    raked = mixing.rake(cells, {"lang": lang})
    got = {(r.dimension, r.value): r for r in mixing.reached(cells, raked, {"lang": lang}).collect()}
    q = got["topic", "q"]
    share = 200**0.7 / (200**0.7 + 17000**0.7)
    assert q.goal == pytest.approx(share * 0.7 * 17200) and q.goal > q.n_tokens == 200
    assert q.weight == pytest.approx(200)
    assert (got["lang", "de"].n_tokens, got["lang", "de"].weight) == (0, 0) and got["lang", "de"].goal == pytest.approx(1204)
    for d in mixing.DIMENSIONS:
        weights = sum(r.weight for r in got.values() if r.dimension == d)
        assert weights == pytest.approx(sum(r.weight for r in raked.collect()))
