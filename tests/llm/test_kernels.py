"""Kernels without Spark, against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mizan.llm import common, decontaminate, html, jaccard, licences, neighbours, pieces, quality, toxicity, warc, wordpiece

PATH = public_tokenizers.path(pieces.MODEL)
ODD = ["", " ", "  a  b", "\n\n x\r\n", "▁▁ a▁b", "é𐍈\x00ab", "a" * 3000, "日本語テスト ابجد", "� x ​", "<s> </s> <unk> <0x41>", " \n \n▁"]


@pytest.mark.parametrize("text", ODD)
def test_pieces_odd(text):
    same_pieces(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab ▁\né𐍈the ing0 1\t\x7f", max_size=60))
def test_pieces_random(text):
    same_pieces(text)


def raw(ids):
    return np.array(ids, "<i4").tobytes()


def same_pieces(text):
    e = pieces.encoder(PATH)
    ids = e.encode(text)
    assert ids == e.library.encode(text) and e.decode(ids) == e.library.decode(ids)
    for _ in range(2):  # as new and as remembered parts
        assert e.both_ways([text]) == [(raw(ids), e.library.decode(ids))]
    e.check([text], [raw(ids)], [e.library.decode(ids)])
    assert pieces.joined(e.decimals, np.array(ids, np.int32)) == ",".join(map(str, ids)).encode()
    parts = sorted({*pieces.PARTS.findall(" " + pieces.marked(text))})
    whole, others = e.merged_all(parts)
    assert dict(whole) | {p: raw(i) for p, i in others} == {p: raw(e.merge(p)) for p in parts}
    assert all(e.text_of(e.merge(p)) == p for p, _ in whole)


def test_pieces_decode_any_ids():
    e, rng = pieces.encoder(PATH), random.Random(1)
    for _ in range(2000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(3, 259) for _ in range(rng.randint(0, 12))]
        assert e.decode(ids) == e.library.decode(ids), ids


def test_wrong_pieces_are_found():
    e = pieces.Encoder(PATH)
    (ids, text), none = e.both_ways(["hello there", ""])
    assert none == (b"", "")
    e.check(["hello there"], [ids], [text])
    for wrong in (([raw([5])], [text]), ([ids], ["hello  there"])):
        with pytest.raises(ValueError):
            e.check(["hello there"], *wrong)


def test_longest_match():
    first, rest = wordpiece.vocabulary(PATH)
    automaton, rng = wordpiece.Automaton(first, rest), random.Random(2)
    words = ["", "the", "日本", "zzzqqq", "a" * 500, "straße", "ﬁ"] + ["".join(rng.choice("abthe日éinzq") for _ in range(rng.randint(1, 14))) for _ in range(5000)]
    assert [automaton.count(w) for w in words] == [wordpiece.longest_match(w, first, rest) for w in words]


def test_longest_match_small_vocabulary():
    first, rest = frozenset(["a", "ab", "abc"]), frozenset(["b", "bc", "c", "cd", "bcdx"])
    automaton = wordpiece.Automaton(first, rest)
    for n in range(1, 7):
        for w in map("".join, itertools.product("abcdx", repeat=n)):
            assert automaton.count(w) == wordpiece.longest_match(w, first, rest), w


def test_halves_hit_every_short_item_with_one_substitution():
    for n in range(decontaminate.SHORT, decontaminate.WINDOW):
        for error in range(n):
            assert any(m[error : error + 1] != "1" for m in decontaminate.HALVES), (n, error)
    assert not any(a == b == "1" for a, b in zip(*decontaminate.HALVES))


def test_masks_hit_every_window_with_two_substitutions():
    for errors in itertools.combinations(range(decontaminate.WINDOW), decontaminate.WINDOW - decontaminate.AGREE):
        assert any(all(m[i] == "0" or at + i not in errors for i in range(len(m))) for m in decontaminate.MASKS for at in range(decontaminate.WINDOW - len(m) + 1)), errors


def test_span_hashes_in_pieces(monkeypatch):
    """Hashes are the same wherever a text is cut, and what a worker keeps for them does not follow the length of texts."""
    rng = np.random.default_rng(1)
    data = rng.integers(97, 123, 3 * common.AT_ONCE + 5).astype(np.uint8)
    data[rng.integers(0, len(data), len(data) // 6)] = 32
    data[common.AT_ONCE - 9 : common.AT_ONCE + 9] = 120  # a word across a cut
    starts, ends = common.word_spans(data, common.SPACED)
    monkeypatch.setattr(common, "_POWERS", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    got = common.span_hashes(data, starts, ends)
    assert len(common._POWERS[0]) <= 4 * common.AT_ONCE
    some = [0, *rng.integers(0, len(starts), 300).tolist(), len(starts) - 1]
    assert [int(got[i]) for i in some] == [int(common.span_hashes(data[starts[i] : ends[i]], np.array([0]), ends[i : i + 1] - starts[i])[0]) for i in some]
    assert len(common.span_hashes(data, starts[:0], ends[:0])) == 0


def plain_shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_shingle_sets():
    rng = random.Random(3)
    texts = [None, "", " \n", "a", "A", "a b c d", "a b c d e", "x\xa0y z"] + ["".join(rng.choice("aAb \n\té") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    sets, plain = jaccard.shingles(texts), [plain_shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for i in range(0, len(texts), 3):
        for j in range(i):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])


def test_reach_is_exact():
    for n in range(1, 60):
        for m in range(1, 60):
            need = next(i for i in range(0, 10**6) if 100 * i >= 80 * (n + m - i))
            for shared in (1, 3):
                for rank in range(n):
                    assert (m <= jaccard.reach(n, shared, rank)) == (need <= n - rank + shared - 1)


def test_pack_round_trip():
    t = np.sort(np.random.default_rng(1).integers(0, 1 << 40, 1000).astype(np.uint64))
    assert (jaccard.unpack(jaccard.pack(t)) == t).all()


PAGES = [
    (None, ""),
    ("", ""),
    ("plain text", "plain text"),
    ("<p>a&nbsp;b<p>c<", "a b\n\nc"),
    ("<div class='post-12'><header><h1>T</h1></header><p>x<br>y</p><div class=comments>no</div></div><div id=sidebar>no</div><footer>f", "x y"),
    ("<article><header><h1>T</h1></header><p>x &amp; y</p><aside>no</aside><form>no</form></article><div class='cookie-notice'>no</div>", "T\n\nx & y"),
    ("<p title=\"a>b\">hi</p><script>var a='<p>no</p>'</script><style>p{}</style><!-- no -->", "hi"),
    ("<ul><li>one<li>two</ul>", "one\n\ntwo"),
    ("<p>a < b</p><p hidden>no</p><p style='display: none'>no</p>", "a < b"),
    ("<p>cut<p clas", "cut"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_html(page, text):
    assert html.extract(page, None) == text


def test_html_paths_are_general():
    assert html.best_path("<div class='b item-12 a'><p>some text here</p></div>") == html.best_path("<div class='a b item-7'><p>other text</p></div>") == "/div.a.b.item-#"
    assert html.extract("<main><p>x</p></main><div class=c><p>longer text than that</p></div>", ["/nowhere", "/main"]) == "x"


BODY = "<p>" + "the body of the text " * 12 + "</p>"
BODY_TEXT = " ".join(("the body of the text " * 12).split())


@pytest.mark.parametrize(
    "page",
    [
        "<article><header><h1>T</h1></header><div class=body>{}</div></article>",
        "<article><section class=a><p>T</p></section><section class=b>{}</section></article>",
        "<main><div><div><div><p>T</p></div></div></div><div><div><div>{}</div></div></div></main>",
        "<div class=x><p>T</p><div class=y>{}</div></div><div class=z><p>z</p></div>",
        "<div class=content><div class=a><p>T</p></div><div class=b>{}</div></div>",
        "<article><p>T</p><blockquote>{}</blockquote></article>",
    ],
)
def test_html_keeps_all_parts_of_an_article(page):
    assert html.extract(page.format(BODY), None) == "T\n\n" + BODY_TEXT
    part = html.parse(page.format(BODY))[0][1][2][-2].path
    assert html.extract(page.format(BODY), [part]) == "T\n\n" + BODY_TEXT


def test_html_words_within_class_names_spare_paragraphs():
    page = "<article><p>start</p>" + BODY + "<p class='notice-text'>of the article</p><p class=notice>no</p></article>"
    assert html.extract(page, None) == "start\n\n" + BODY_TEXT + "\n\nof the article"
    wrapper = "<div class='site has-sidebar'><div class=content><p>short</p></div><div class=sidebar>a long text beside it, longer than that</div></div>"
    assert html.extract(wrapper, None) == "short"


@pytest.mark.parametrize(
    "page",
    [
        "<div class='layout has-sidebar'><article>{}</article><div class=sidebar><p>side</p></div></div>",
        "<div id=page class=content-sidebar-wrap><main>{}</main><div class=sidebar-left><p>side</p></div></div>",
        "<div class='post social-enabled'>{}</div><div class=related><article><p>teaser</p></article></div>",
        "<div class='has-sidebar'><div class='entry comments-closed'>{}</div></div><div class=comments><p>c</p></div>",
        "<form id=all><main>{}</main></form><nav><p>menu</p></nav>",
        "<div class=widget>{}</div><footer><p>foot</p></footer>",
    ],
)
def test_html_never_cuts_the_article(page):
    assert html.extract(page.format(BODY), None) == BODY_TEXT


def test_html_long_pages_end():
    assert len(html.extract("<p>" + "<b>x</b> " * 20000 + "<a href='" + "y" * 200000, None)) > 1000


def plain_scan(text):
    w, starts, labels = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(licences.ASCII_LOWER)), [], set()
    for i in range(len(w)):
        for phrase, label in licences.BASE.items():
            q = phrase.split()
            if w[i : i + len(q)] == q:
                starts.append(i)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_licence_places():
    rng, words = random.Random(2), "gnu general public license apache mit cc by x é MIT License -by. by,sa nc Apache\n".split(" ")
    for text in [None, "", "...", *("".join(rng.choice(words) + rng.choice([" ", "  ", "-", "\n", ", "]) for _ in range(rng.randint(0, 14))) for _ in range(5000))]:
        assert licences.scan(text)[:5] == plain_scan(text), text


@pytest.mark.parametrize(
    "tokens, order",
    [("a or b and c", "a b c and or"), ("( a or b ) and c", "a b or c and"), ("a with x or b", "a x with b or"), ("a b", None), ("( a", None), ("a )", None), ("or a", None), ("", None), ("a or", None)],
)
def test_shunting_yard(tokens, order):
    got = licences.postfix(tokens.split())
    assert got == (order.split() if order is not None else None)


def test_licence_expressions():
    assert licences.scan("SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND Apache-2.0\nx")[5:] == ("apache-2.0,classpath-exception-2.0,gpl-2.0,mit", 1.0, 1.0)
    assert licences.scan("SPDX-License-Identifier: GPL-3.0-or-later and more")[5:] == ("gpl-3.0", 1.0, 0.4)
    # What is unknown stays in the expression, under its own name.
    assert licences.scan("SPDX-License-Identifier: MIT AND LGPL-2.0-only")[5:] == ("lgpl-2.0-only,mit", 1.0, 0.6)
    assert licences.scan("// SPDX-License-Identifier: Apache-2.0 AND NOASSERTION")[5:] == ("apache-2.0,noassertion", 1.0, 0.5)
    assert licences.scan("SPDX-License-Identifier: Artistic-2.0 OR MIT")[5:] == ("artistic-2.0,mit", 1.0, 1.0)
    assert licences.scan("é SPDX License Identifier: MIT\nand text")[5:] == ("mit", 1.0, 1.0)
    assert licences.scan("/* SPDX-License-Identifier: (MIT OR ISC */")[5:] == ("isc,mit", 1.0, 1.0)
    assert licences.scan("the license identifier is MIT")[5:] == ("", 0.0, None)
    assert licences.scan("SPDX-License-Identifier:\n")[5:] == ("", 0.0, None)
    assert licences.scan("Licensed under CC BY-NC 4.0.")[4:6] == ("cc-by", "cc-by,cc-by-nc")


def test_warc_record_round_trip():
    for payload in (b"", b"x", "é".encode() * 1000, b"\r\n\r\n"):
        head, block = warc.parsed(warc.record("response", 7, "http://a/\n", payload))
        assert warc.fields(head, block)[2:] == ("response", len(payload), warc.base32(hashlib.sha1(payload).digest()), None, payload)
        head, block = warc.parsed(warc.record("revisit", None, "u", payload, 9))
        assert warc.fields(head, block) == (None, "u", "revisit", len(payload), warc.base32(hashlib.sha1(payload).digest()), 9, None)
    with pytest.raises(ValueError):
        warc.parsed(warc.record("response", 1, "u", b"abc").replace(b"abc", b"abd"))


def test_chi_square():
    assert abs(neighbours.chi2_cdf(neighbours.chi2_quantile(0.95, 8), 8) - 0.95) < 1e-9
    assert abs(neighbours.chi2_quantile(0.95, 8) - 15.507) < 1e-2


def test_tree_finds_all_when_certain():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 16))
    x[100:200] = x[99]
    ids = np.arange(3000)
    matrix = neighbours.projection(16)
    tree = neighbours.Tree(x @ matrix)
    for own in (0, 99, 150, 2999):
        got = tree.search(x[own] @ matrix, x[own], x, ids, own, 10, neighbours.chi2_quantile(0.999999, 8), float("inf"))
        d = np.sqrt(((x - x[own]) ** 2).sum(axis=1))
        d[own] = np.inf
        want = np.lexsort((ids, d))[:10]
        assert [i for _, i in got] == want.tolist() and np.allclose([s for s, _ in got], d[want])


def test_blocks_hold_their_points():
    p = np.random.default_rng(6).standard_normal((5000, neighbours.DIMENSIONS))
    tree = neighbours.splits(p, 8)
    where, (low, high) = neighbours.place(p, tree), neighbours.boxes(tree)
    assert set(where) == set(range(8)) and np.bincount(where).max() < 800
    assert (p >= low[where]).all() and (p <= high[where]).all()


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def test_quality_learns():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("aeiourtns") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    good = [words(rng, rng.randint(5, 80), vocabulary) + "." for _ in range(400)]
    bad = ["!! ".join(words(rng, rng.randint(5, 80), vocabulary).upper().split()) for _ in range(200)]
    texts, labels = good + bad, [1] * 400 + [0] * 200
    order = rng.sample(range(600), 600)
    index, at = quality.grams([texts[i] for i in order])
    rows = [(*quality.features(index[a:b]), labels[i]) for i, a, b in zip(order, at, at[1:])]
    w = quality.train(rows[:450])
    s = quality.scores([texts[i] for i in order[450:]], w)
    assert ((s >= quality.THRESHOLD) == [labels[i] == 1 for i in order[450:]]).mean() > 0.97
    again = quality.scores([None, "", texts[0], texts[0]], w)
    assert again[0] == again[1] and again[2] == again[3] and np.isfinite(again).all()


def test_quality_scores_do_not_depend_on_batches():
    w = np.random.default_rng(1).standard_normal(quality.BUCKETS + 1).astype(np.float32)
    texts = ["a b b c 12 34", "", "X!! Y!!", None, "é è ß"]
    assert np.allclose(quality.scores(texts, w), [quality.scores([t], w)[0] for t in texts], atol=1e-9)


def test_toxicity_learns():
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("aeiourtns") for _ in range(rng.randint(2, 9))) for _ in range(800)]
    rude = ["glarfon", "blistrack", "zumpfel", "quorkish"]
    plain = [words(rng, rng.randint(30, 200), vocabulary) for _ in range(600)]
    toxic = [" ".join(w if rng.random() > 0.06 else rng.choice(rude) for w in words(rng, rng.randint(30, 200), vocabulary).split()) for _ in range(300)]
    toxic = [t for t in toxic if any(r in t for r in rude)]  # short ones may have got none
    model = toxicity.train(toxic[:200], plain[:400])
    pair = model.compressors()
    p = lambda t: toxicity.probability(toxicity.evidence(t, *pair)[0], model)
    assert np.mean([p(t) >= toxicity.THRESHOLD for t in toxic[200:]]) > 0.9
    assert np.mean([p(t) < toxicity.THRESHOLD for t in plain[400:]]) > 0.97
    assert p("") == p(None) < toxicity.THRESHOLD


def test_toxicity_without_labels():
    model = toxicity.train([], [])
    assert toxicity.probability(toxicity.evidence("anything", *model.compressors())[0], model) < toxicity.THRESHOLD


def test_telling_windows_are_cut_from_the_texts():
    good = {b" scum ", b"idioti"}
    texts = [b"that scum and idiotic talk\nscum again", b"", b"abc"]
    got = toxicity.telling(texts, good)
    assert got == [b"t scum and ", b" idiotic ta", b"k scum agai"]
    assert toxicity.telling(texts, set()) == []


def test_windows_cover_the_text():
    for t in (b"", b"a" * 1000, b"ab " * 500):
        assert b"".join(toxicity.windows(t)) == t and all(len(w) <= toxicity.WINDOW for w in toxicity.windows(t))


def test_members_are_gzip():
    assert zlib.decompress(warc.member(b"abc"), 31) == b"abc"
