"""Operators on single texts, against the library, brute force or known results."""

import random
import re
import time
from html.parser import HTMLParser

import pytest
from tokenizers import Tokenizer

from broadsheet.llm import bpe, html, language, pii, quality
from broadsheet.llm.queries import vocabulary_path

CASES = [
    "", "  ", "it's I'M don't<|endoftext|>x <|startoftext|>", "İstanbul ΣΑΣ Σ", "a\x1cb\x85c", "é é ﬁ ½ 12 345",
    "x" * 5000, "ab" * 3000 + " !!!???", "日本語 😀😀👍🏽", "́ abc", "a\u0000b", "가각힣 가",
]


def test_bpe_equals_the_library():
    path = vocabulary_path()
    library, codec = Tokenizer.from_file(path), bpe.Codec(path)
    rng = random.Random(1)
    texts = CASES + [
        "".join(rng.choice("ab'smtdve re\n\t ÉéΣßİ1２½😀́‍ <|>日\x1f") for _ in range(rng.randrange(60)))
        for _ in range(500)
    ]
    for text, ids in zip(texts, codec.encode_all(texts)):
        right = library.encode(text, add_special_tokens=False).ids
        assert bpe.unpacked(ids).tolist() == right
        assert codec.decode(ids) == library.decode(right, skip_special_tokens=False)


def test_bpe_frame_round_trip_and_nulls(frame, rows):
    docs = frame([(1, None, "x"), (2, "", "y"), (3, "Hello world", None), (3, "Hello world", None)], "doc_id long, text string, ids string")
    encoded = bpe.encode(docs, vocabulary_path())
    assert rows(encoded, "doc_id", "n_tokens") == [(1, 0), (2, 0), (3, 2), (3, 2)]
    decoded = bpe.decode(encoded, vocabulary_path())
    assert rows(decoded, "doc_id", "text")[2] == (3, "hello</w> world</w>")
    assert bpe.digests(docs.limit(0), vocabulary_path()).count() == 0


def plain_spans(text):
    found = []
    for nth, (kind, pattern) in enumerate(
        [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            odd = sum(map(int, digits[::-1][::2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[::-1][1::2])
            right = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".") if kind == "ip"),
                     "card": 12 <= len(digits) <= 19 and odd % 10 == 0, "phone": 9 <= len(digits) <= 15}
            if right[kind]:
                found.append((m.start(), nth, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(found))


def test_base_spans_equal_plain_search():
    rng = random.Random(3)
    for _ in range(5000):
        text = "".join(rng.choice("ab1234567890 .@+-()4 .@") for _ in range(rng.randrange(50)))
        assert pii.as_text(pii.base_spans(text)) == plain_spans(text)


@pytest.mark.parametrize(
    "text, found",
    [
        ("mail john dot doe at example dot com now", ("email", "john dot doe at example dot com")),
        ("see john.doe [at] example [dot] com", ("email", "john.doe [at] example [dot] com")),
        ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", ("email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ")),
        ("jоhn@exаmple.com", ("email", "jоhn@exаmple.com")),
        ("call plus one two three four five six seven eight nine zero", ("phone", "plus one two three four five six seven eight nine zero")),
        ("we met at the park, one two three dot", None),
        ("look at example.com and (at) last", None),
        ("john@example.com", None),
    ],
)
def test_disguises(text, found):
    added = pii.added_spans(text, pii.base_spans(text))
    assert [(k, text[a:b]) for a, b, k in added] == ([found] if found else [])


def test_pii_frame(frame, rows):
    docs = frame([(1, None), (2, ""), (None, "a@b.c and 1.2.3.4")], "doc_id long, text string")
    assert rows(pii.digests(docs).where("doc_id is null"), "n_email", "n_ip", "spans") == [(1, 1, "email:0:5,ip:10:17")]
    assert rows(pii.digests(docs).where("doc_id = 1"), "n_email", "spans") == [(0, "")]


def test_measures_equal_plain_counts():
    rng = random.Random(4)
    for _ in range(2000):
        text = "".join(rng.choice("ab \n\x1c\x0b#é\x85") for _ in range(rng.randrange(60)))
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = list(zip(words, words[1:], words[2:]))
        covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert quality.measures(text) == (
            len(words), sum(map(len, words)), text.count("#"), len(lines) - len(set(lines)), len(lines), len(covered),
        )


def test_host_verdicts(frame, rows):
    clean, bad = " ".join(f"word{i}" for i in range(60)), " ".join(f"w{i}###" for i in range(60))
    docs = frame(
        [(i, bad, "junk") for i in range(30)] + [(100, clean, "junk")] + [(200 + i, clean, "good") for i in range(30)]
        + [(300, bad, "good"), (400, None, None)],
        "doc_id long, text string, source string",
    )
    kept = {r.doc_id for r in quality.judged(docs).where("kept").collect()}
    assert kept == {100, 300} | {200 + i for i in range(30)}
    assert quality.judged(docs.limit(0)).count() == 0


def test_small_hosts_stay_near_the_mean(frame):
    """One bad document says little about a host of one; many say much about a large one."""
    small = [(f"h{i}", i == 0) for i in range(120)]
    rates = {r.host: r.rate for r in quality.host_rates(frame(small, "host string, failed boolean")).collect()}
    assert all(abs(rate - 1 / 120) < 0.02 for rate in rates.values())
    large = [(f"bad{i}", k < 36) for i in range(5) for k in range(40)] + [(f"good{i}", k < 2) for i in range(5) for k in range(40)]
    rates = {r.host: r.rate for r in quality.host_rates(frame(large + [("one", True)], "host string, failed boolean")).collect()}
    assert all(rates[f"bad{i}"] > 0.8 and rates[f"good{i}"] < 0.15 for i in range(5)) and 0.4 < rates["one"] < 0.8
    alike = quality.host_rates(frame([(f"h{i % 9}", False) for i in range(90)], "host string, failed boolean"))
    assert {r.rate for r in alike.collect()} == {0.0}


class Events(html.Tokeniser):
    """What the tokeniser finds, as the standard library's parser would tell it."""

    def __init__(self):
        self.found = []

    def in_foreign(self):
        return False

    def handle_starttag(self, tag, attrs):
        self.found.append(("start", tag, attrs))

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        self.found.append(("end", tag))

    def handle_data(self, data):
        if self.found and self.found[-1][0] == "text":
            data = self.found.pop()[1] + data
        self.found.append(("text", data))


class Expected(HTMLParser):
    CDATA_CONTENT_ELEMENTS = ("script", "style")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found = []

    handle_starttag = handle_startendtag = Events.handle_starttag
    handle_endtag, handle_data = Events.handle_endtag, Events.handle_data


def test_tokens_equal_the_library_parser(spark):
    rng = random.Random(12)
    parts = [
        "<p>", "</p>", "<a href='x>y' b=1 C>", '<img alt="a &amp; b"/>', "<br/>", "<!-- c <b> -->", "<!doctype html>", "text &lt; &eacute;",
        " a < b ", "<script>if (a<b) '</p>'</script>", "<style>x{}</style>", "\n", "<td rowspan=2>", "</td >", "<x-y data-z=\"1 2\">", "é", "<?pi?>",
        "<b disabled = yes>", "&amp;copy", "a > b", "<i/ >",
    ]
    pages = ["".join(rng.choices(parts, k=rng.randrange(1, 30))) for _ in range(3000)]
    pages += [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect() if r.html]
    for page in pages:
        ours, theirs = Events(), Expected()
        ours.feed(page)
        theirs.feed(page)
        theirs.close()
        assert ours.found == theirs.found, page


@pytest.mark.parametrize("part", ["<a ", "<!--", "<a b='", "<![CDATA[", "<script>", "</", "<!", "<title>", "<td>", "&", "<svg><![CDATA["])
def test_malformed_pages_take_linear_time(part):
    def seconds(n):
        begun = time.perf_counter()
        html.page_text(part * n)
        return time.perf_counter() - begun

    assert seconds(200_000) < 20 * max(0.02, seconds(20_000))


def test_rows_under_cells_of_several_rows():
    page = "<table><tr><td rowspan=2>A<td>B<td>X<tr><td>C<td>Y<tr><td>D<td colspan=2>E</table>"
    assert html.page_text(page) == "A  B  X\n   C  Y\nD  E"
    page = "<table><tr><td rowspan=0>A<td>B<tr><td>C<tbody><tr><td>D<td rowspan=9>E<tr><td>F<tr><td>G</table><xmp><b></xmp><dialog>no</dialog><dialog open>yes</dialog>"
    assert html.page_text(page) == "A  B\n   C\nD  E\nF\nG\n\n<b>\nyes"


def test_page_layout():
    page = (
        "<head><title>T</title><body><h1>Head</h1><p>One <b>two</b>\nthree<p>Four<br>five<ul><li>a<li>b<ul><li>c</ul></ul>"
        "<table><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td>b<td>22</table>tail<pre>  x\n y</pre>"
        "<div hidden>no</div><p style='display: none'>no</p><script>no</script>&lt;&amp;"
    )
    assert html.page_text(page) == (
        "Head\n\nOne two three\n\nFour\nfive\n\n- a\n- b\n  - c\n\nName   N\nalpha  1\nb      22\n\ntail\n\n  x\n y\n\n<&"
    )
    assert html.page_text(None) == html.page_text("") == ""
    assert "end" in html.page_text("<div>" * 5000 + "end")


def test_pages_frame(frame, rows):
    pages = frame([(1, "u", None, "x"), (2, None, "<p>a</p>", "y")], "page_id long, url string, html string, text string")
    assert rows(html.extracted(pages), "page_id", "text") == [(1, ""), (2, "a")]


def test_code_lengths_are_those_of_the_table():
    sample = [("en", b"the cat sat on the mat"), ("fr", "le chat est là".encode())]
    counts = {}
    for lang, data in sample:
        for length in range(1, 5):
            for i in range(len(data) - length + 1):
                key = lang, length, int.from_bytes(data[i : i + length], "big")
                counts[key] = counts.get(key, 0) + 1
    model = language.trained([(*k, n) for k, n in counts.items()])
    # the chances after any context sum to one, with the unseen bytes of the last class
    n = int(model.classes.max()) + 1
    chances = 2.0 ** -model.costs.reshape(-1, n, 2)
    unseen = 256 - (n - 1)
    totals = chances[:, :-1].sum(1) + unseen * chances[:, -1]
    assert abs(totals - 1).max() < 1e-3
    texts = [b"the mat", b"", "là le chat".encode() * 50]
    whole, (language._BLOCK, kept) = model.bits(texts), (7, language._BLOCK)
    try:
        assert abs(model.bits(texts) - whole).max() < 1e-3
    finally:
        language._BLOCK = kept
    assert whole[0].argmin() == 0 and whole[2].argmin() == 1 and (whole[1] == 0).all()


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.98 * found.count() > 100


def test_language_cases(frame, rows):
    docs = frame([(1, None, "en"), (2, "12 34", "en"), (3, "the cat", None), (None, "the dog", "en")], "doc_id long, text string, lang string")
    found = rows(language.predicted(docs).where("doc_id < 3"), "doc_id", "lang_pred", "score")
    assert found == [(1, "und", 0.0), (2, "und", 0.0)]
    assert language.predicted(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        ("<table><td>A<td>B</table>", "A  B"),
        ("<table><thead><th>A</th></thead><tbody><td>b<tr><td>c</table>tail", "A\nb\nc\n\ntail"),
        ("<table><tr><td>a</td></tr><td>b</td><th>c</th><tfoot><td>d</table>", "a\nb  c\nd"),
        ("<table><colgroup><col><td>A</table>", "A"),
        ("<table><tr><div>before<td>A</table>", "before\nA"),
        ("<table><td>A<table><td>in</table>B<td>C</table>", "A   C\n\nin\n\nB"),
    ],
)
def test_cells_without_rows(page, text):
    assert html.page_text(page) == text


def test_cells_at_any_depth():
    for depth in range(html.DEEPEST - 8, html.DEEPEST + 3):
        for rows in ("<td>one<td>two", "<tr><td>one<td>two", "<tbody><tr><th>one<tr><td>two"):
            text = html.page_text("<div>" * depth + f"<table>{rows}</table>")
            assert "one" in text and "two" in text


@pytest.mark.parametrize("tag", ["a", "span", "x-card", "b", "img alt=see", "label", "basefont"])
def test_head_ends_before_what_may_not_stand_in_it(tag):
    page = f"<head><meta charset=utf-8><title>T</title><{tag}>text<p>more"
    assert html.page_text(page) in ("text\n\nmore", "seetext\n\nmore")
    assert html.page_title(html.parsed(page)) == "T"


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p><svg class=i /> text</p>more", "text\n\nmore"),
        ("<p>a<svg><path d='M0 0'/><use href='#x'/></svg>b<math/>c<p>d", "abc\n\nd"),
        ("<svg><title>no</title><desc>no</desc><metadata>no</metadata><text>one</text><text>two</text></svg> three", "one two three"),
        ("<svg><text><![CDATA[a < b]]></text></svg>", "a < b"),
        ("<svg><title/><desc/>after</svg>", "after"),
        ("<svg><metadata><p>a paragraph ends SVG", "a paragraph ends SVG"),
        ("<svg><foreignObject><div/>in it<p>more</foreignObject><g/><text>t</text></svg>", "in it\n\nmore\n\nt"),
        ("<svg style='display:none'><text>no</text></svg><svg><text display=none>no</text></svg>yes", "yes"),
        ("x <math><mi>a</mi><mo>=</mo><mn>2</mn></math> y", "x a=2 y"),
        ("<math><semantics><mi>a</mi><annotation>no</annotation></semantics></math>b", "ab"),
        ("Pick <select><optgroup label=G><option>one<option selected>two</optgroup><option label=three></select>now", "Pick G one two three now"),
        ("<div/>in<p/>out", "in\n\nout"),
        ("<table><tr><td><svg><path/></svg>A<td><select><option>B</select></table>", "A  B"),
    ],
)
def test_svg_formulas_and_options(page, text):
    assert html.page_text(page) == text


@pytest.mark.parametrize(
    "address",
    [
        "jоhn@example.com", "јohn@example.com", "jo\u200bhn@example.com", "john\u200b@example.com", "j\u00adohn@example.com",
        "john@example.cоm", "john@example.co\u200bm", "john@exаmple.com", "john@exam\u2060ple.com", "jоhn@exаmple.cоm",
    ],
)
def test_disguised_addresses_are_found_whole(address):
    text = f"mail {address} or kim@example.org"
    base = pii.base_spans(text)
    assert [text[a:b] for a, b, _ in pii.added_spans(text, base)] == [address]
    assert base == pii.base_spans(text) and "kim@example.org" in [text[a:b] for a, b, _ in base]


def test_spans_that_base_spans_cover_are_not_added():
    assert list(pii.uncovered({(1, 4), (2, 6), (7, 9), (7, 12), (20, 22)}, [(0, 5), (7, 9)])) == [(2, 6), (7, 12), (20, 22)]


@pytest.mark.parametrize(
    "text, found",
    [
        ("host 192[.]168[.]1[.]10 is up", ("ip", "192[.]168[.]1[.]10")),
        ("host 192 dot 168 dot 1 dot 10 is up", ("ip", "192 dot 168 dot 1 dot 10")),
        ("host 192 (dot) 168.1[dot]10", ("ip", "192 (dot) 168.1[dot]10")),
        ("host one nine two dot one six eight dot one dot one zero.", ("ip", "one nine two dot one six eight dot one dot one zero")),
        ("host 192.168.1.one, or", ("ip", "192.168.1.one")),
        ("ring +1 555 867 five three oh nine today", ("phone", "+1 555 867 five three oh nine")),
        ("ring plus 1 555 867  five three zero 9 today", ("phone", "plus 1 555 867  five three zero 9")),
        ("ring +1 (555) 867-five three oh nine", ("phone", "+1 (555) 867-five three oh nine")),
        ("ring +1 dot 555 dot 867 dot 5309", ("phone", "+1 dot 555 dot 867 dot 5309")),
        ("card 4111 1111 1111 one one one one", ("card", "4111 1111 1111 one one one one")),
        ("in 2024, " + "four" + " one" * 15 + ".", ("card", "four" + " one" * 15)),
        ("to a dot b dot c at x dot com", ("email", "a dot b dot c at x dot com")),
        ("to john  dot  doe   at  example  dot  com", ("email", "john  dot  doe   at  example  dot  com")),
        ("to john at example[.]com", ("email", "john at example[.]com")),
        ("to john \t@\texample.com", ("email", "john \t@\texample.com")),
        ("one, two@example.com and version 2 dot 5, three of 4", None),
        ("plus 100 000 000 or 192 dot 168 dot 1 or 300[.]1[.]1[.]1", None),
    ],
)
def test_disguised_numbers_and_dots(text, found):
    added = pii.added_spans(text, pii.base_spans(text))
    assert [(k, text[a:b]) for a, b, k in added] == ([found] if found else [])


def test_disguises_take_time_in_proportion():
    for text in ("a.b" * 20000, "a dot " * 20000, "one two " * 20000, "1 dot 2 (" * 20000, "x" + " " * 60000 + "dot", "[ " * 30000):
        began = time.process_time()
        pii.added_spans(text, pii.base_spans(text))
        assert time.process_time() - began < 5
