from __future__ import annotations

import glob
import random
import zlib
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marketlake.llm import html_extract as H
from marketlake.llm import packing as P
from marketlake.llm.line_dedup import RATIO
from tests.llm.test_dedup import brute_lines

SF = "/root/testdata/sf0.001"
ART = "<article><h1>Title &amp; more</h1><p>One  <b>two</b>\n&eacute;&#233;<br>x<p>Three</article>"


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("body", "want"),
    [
        (f"<nav><ul><li><a href='/'>Home</a></ul></nav><div class='ad'>Buy</div>{ART}<footer>&copy;</footer>", "Title & more\nOne two éé x\nThree"),
        ("<main><p>In</p><form>f<input></form><aside>s</aside><p>main</p></main><p>out</p>", "In\nmain"),
        ("<article><p>a</p><div class='comments'><article class=comment>no</article></div><div id=\"cookie-notice\">n</div><p>b</article>", "a\nb"),
        ("<article>text<!-- c --> with<script>if (a < b) {}</script> gaps &lt;b&gt; &am</article>", "text with gaps <b> &am"),
        ("<form><article><p>wrapped</p></article></form>", "wrapped"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>1<td>2</table></article>", "a\nb\n1\n2"),
        ('<article><p title="a > b">q</p><p class=>r</p></article>', "q\nr"),
        ("<article><p>a < b and <3</p></article>", "a < b and <3"),
        ("<article></article>", ""),
        ("<article>a<video src=x>b<script>never closed</article>", "ab"),
        ("<article class='post share related'>kept<div class='share'>no</div></article>", "kept"),
        ("<p>alone on its page</p>", "alone on its page"),
    ],
)
def test_extraction(spark, body, want):
    df = spark.createDataFrame([(1, "http://h/x", page(body), "t", "k")], "page_id bigint, url string, html string, text string, key string")
    (r,) = H.extract_pages(df).collect()
    assert (r.page_id, r.url, r.text, r.n_chars) == (1, "http://h/x", want, len(want))


def test_repeated_runs_of_a_host_go_where_markup_is_silent(spark):
    menu = "<div>" + " ".join(f"menu{i}" for i in range(12)) + "</div>"
    rows = [(i, f"http://a.example/{i}", page(f"{menu}<div>own text of page number {i} with words {i * 7} that stand nowhere else</div>")) for i in range(3)]
    rows += [(10, "http://b.example/", page(f"{menu}<div>once</div>")), (11, "http://a.example/copy", rows[0][2]), (12, None, None), (None, "nonsense", ""), (13, "http://c.example", page("x " * 300_000))]
    rows += [(14, "http://c.example/2", page("<article>" + "y " * 100_000 + "</article>")), (14, "http://c.example/2", page("<article>z</article>"))]
    out = H.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert len(out) == len(rows)
    text = {(r.page_id, r.url): r.text for r in out}
    for i in range(3):
        assert text[i, f"http://a.example/{i}"] == f"own text of page number {i} with words {i * 7} that stand nowhere else"
    assert text[11, "http://a.example/copy"] == text[0, "http://a.example/0"]
    assert text[10, "http://b.example/"].endswith("menu11\nonce")
    assert text[12, None] == "" and text[None, "nonsense"] == "" and len(text[13, "http://c.example"]) == 599_999
    assert H.extract_pages(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 9))
def test_suffixes_are_sorted(tokens, depth):
    order, rank = H.sorted_suffixes(np.array(tokens, np.int64), depth)
    heads = [tuple(tokens[i : i + depth]) for i in range(len(tokens))]
    assert [heads[i] for i in order] == sorted(heads)
    assert [rank[i] == rank[j] for i in range(len(tokens)) for j in range(i)] == [heads[i] == heads[j] for i in range(len(tokens)) for j in range(i)]


def brute_runs(streams, share, least=1):
    """Runs of RUN words on more than share of the streams, and on how many."""
    count = {}
    for s in streams:
        w = s.split(" ")
        for run in {tuple(w[i : i + H.RUN]) for i in range(len(w) - H.RUN + 1)}:
            count[run] = count.get(run, 0) + 1
    return {int(H.run_hashes(list(r))[0]): n for r, n in count.items() if n >= least and n > share * len(streams)}


def repeating_streams(rng, n):
    parts = [" ".join(rng.choice("abc") for _ in range(14)) for _ in range(5)]
    return [" ".join([rng.choice(parts) if rng.random() < 0.6 else " ".join(rng.choice("abcdefg") for _ in range(9)) for _ in range(rng.randint(0, 6))]) for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_frequent_runs_against_brute_force(seed):
    streams = repeating_streams(random.Random(seed), 12) + ["", "one"]
    for share in (0.0, 0.3, 0.5):
        assert dict(zip(*(x.tolist() for x in H.frequent_runs(streams, share)))) == brute_runs(streams, share)


@pytest.mark.parametrize("chars", [10**6, 150])  # a suffix array for each host, or several
def test_boilerplate_of_hosts_against_brute_force(spark, monkeypatch, chars):
    monkeypatch.setattr(H, "PART_CHARS", chars)
    rng = random.Random(9)
    menu = " ".join(f"menu{i}" for i in range(11))
    hosts = {"a": list(dict.fromkeys(s + f" {menu}" * (i % 3 > 0) for i, s in enumerate(repeating_streams(rng, 40)))), "b": list(dict.fromkeys(repeating_streams(rng, 7))), "c": ["x y z " * 9] * 2, "": ["q " * 20 + str(i) for i in range(5)]}
    rows = [(h, k, s) for h, streams in hosts.items() for k, s in enumerate(streams)]
    runs, sizes = H.boilerplate_runs(spark.createDataFrame(rows, "host string, key bigint, stream string"))
    want = {(h, r) for h, streams in hosts.items() for r in brute_runs(streams, H.SHARE, H.LEAST)}
    assert {(r.host, r.run) for r in runs.collect()} == want and {h for h, _ in want} >= {"a", ""}
    assert (max(r.parts for r in sizes.collect()) > 1) == (chars < 1000)


@pytest.mark.parametrize("chars", [8_000_000, 300])
def test_pages_whose_articles_are_not_marked(spark, monkeypatch, chars):
    """Without article tags the text is the same: what repeats on the host goes, the rest stays."""
    monkeypatch.setattr(H, "PART_CHARS", chars)
    monkeypatch.setattr(H, "BROADCAST_RUNS", chars - 300)  # runs come to the pages, or pages to the runs
    menu = "".join(f"<div>menu {i}</div>" for i in range(9))
    foot = "<div>about this site and who it is that writes it</div>"
    mixed = "published by the staff of this site every day of the week"
    rng = random.Random(2)
    text = {i: "\n".join(" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(1, 30))) for _ in range(4)) for i in range(30)}
    body = lambda t: menu + "".join(f"<div>{p}</div>" for p in t.split("\n")) + f"<div>{t.split()[0]} {mixed}</div>" + foot
    rows = [(i, f"http://a.example/{i}", page(body(t))) for i, t in text.items()]
    rows += [(100 + i, "http://b.example/x", page(body(text[i]))) for i in range(2)]
    out = {r.page_id: r.text for r in H.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert {i: out[i] for i in text} == {i: t + "\n" + t.split()[0] for i, t in text.items()}
    assert all(mixed in out[100 + i] and "menu 8" in out[100 + i] for i in range(2))  # two pages tell nothing


def test_given_pages_without_article_tags(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id % 2 = 0")
    plain = pages.withColumn("html", F.regexp_replace("html", r"(</?)article\b", "$1div"))
    want = {r.page_id: r.text for r in H.extract_pages(pages).collect()}
    assert {r.page_id: r.text for r in H.extract_pages(plain).collect()} == want


def test_blocks_beside_the_text_need_proof(spark):
    beside = lambda i: f"<p>unique note of page {i} with some more words {i}</p><p>short {i}</p><p>the same note on each of the pages here</p>"
    rows = [(i, "http://a.example/", page(f"{beside(i)}<main><p>story {i}</p></main>")) for i in range(3)] + [(9, "http://b.example/", page(f"{beside(9)}<main><p>story</p></main>"))]
    out = {r.page_id: r.text for r in H.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert out == {**{i: f"unique note of page {i} with some more words {i}\nstory {i}" for i in range(3)}, 9: "story"}


TOKENIZER = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))


def ids(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@given(st.lists(st.text(alphabet="abcAZé'´Σσİß ǰ̌\x1c\x85\xa0.,;:!12|<>\n", max_size=40), max_size=6))
def test_encoder_equals_the_tokenizer(texts):
    texts = [*texts, "it's don't I'LL", "x<|endoftext|>y <|startoftext|>", "a\x1fb c", "word. word, Word; ΑΣ."]
    assert P.encoder(P.TOKENIZER).ids(texts) == [ids(t) for t in texts]


@given(st.lists(st.integers(1, 50), max_size=80))
def test_first_fit_decreasing(lengths):
    bins, want = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        j = next((j for j, free in enumerate(bins) if free >= lengths[i]), len(bins))
        if j == len(bins):
            bins.append(50)
        bins[j] -= lengths[i]
        want[i] = j
    assert P.first_fit_decreasing(lengths, 50) == want


def check_packing(rows, texts, space):
    """Every id of every document lies in one piece, and sequences have no gaps."""
    docs = sorted(((ids(t) + (2).to_bytes(4, "little")) for t in texts), key=lambda b: (len(b), zlib.crc32(b)))
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= space
    assert sum(r.length for r in rows) == sum(len(d) // 4 for d in docs)
    crcs = sorted((k * space, zlib.crc32(d[4 * k * space : 4 * (k + 1) * space])) for d in docs for k in range(-(-len(d) // 4 // space)))
    assert sorted((r.start, r.ids_crc32) for r in rows) == crcs
    return sum(0 if n & (n - 1) == 0 else space - n for n in (sum(x[1] for x in s) for s in by_seq.values()))


def test_packing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = [(None, None), (None, ""), (9001, "x " * 50_000), (9002, "same"), (9002, "same"), (None, "no id")]
    both = docs.union(spark.createDataFrame(odd, docs.schema)).withColumns({"group": F.lit(1), "length": F.lit("x")})
    rows = P.pack(both, group_docs=60).collect()
    texts = [r.text for r in both.collect()]
    padding = check_packing(rows, texts, P.SEQUENCE)
    assert len({r.sequence_id >> 32 for r in rows}) > 1 and padding < 0.05 * sum(r.length for r in rows)
    assert P.pack(docs.limit(0)).count() == 0


def test_groups_of_repeated_rows_and_of_one_huge_document(spark):
    rows = [(7, "the same row")] * 3000 + [(8, "word of many " * 100_000)] + [(i, f"own {i}") for i in range(100, 1100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2)
    out = P.pack(df, space=64, group_docs=100).collect()
    check_packing(out, [t for _, t in rows], 64)
    size = {}
    for r in out:
        size[r.sequence_id >> 32] = size.get(r.sequence_id >> 32, 0) + 1
    assert len(size) == 40 and max(size.values()) < 2 * len(out) / 40


def test_other_tokenizers_encode_whole_texts():
    enc = P.Encoder("byte_bpe_50k.json")
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["Some TEXT, with  spaces\nand 'marks'.", "", None]
    assert not enc.by_words and P.encoder(P.TOKENIZER).by_words
    assert enc.ids(texts) == [np.array(plain.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_pipeline_against_brute_force(spark, tmp_path):
    import shutil

    from marketlake.llm import decontaminate as D
    from marketlake.llm.language_id import LEAST_SCORE, predicted, train_language_model
    from tests.llm.test_near_copies import brute_kept
    from tests.llm.test_search import brute_distance

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9001, None, "en", "src0", 0), (9002, "123 456", None, None, 7), (9003, docs.first().text, "en", "src1", 1), (9004, "a line of its own\nand one more", "en", "src2", 30), (9005, "\u4e2d\u6587" * 40, None, "src2", 80)]
    shutil.copy(f"{SF}/benchmark.parquet", tmp_path)
    docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("sequence_id", F.lit("mine")).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    all_docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    scores = {r.doc_id: r.p for r in predicted(all_docs, train_language_model(all_docs.select("doc_id", "text", "lang")), to="p").collect()}
    rows = [(r.doc_id, r.text, r.source) for r in all_docs.collect() if r.text and any(c.isalpha() for c in r.text) and scores[r.doc_id].score >= LEAST_SCORE]
    assert {r[0] for r in rows} - {9005} == {r.doc_id for r in docs.collect()} | {9003, 9004}
    rows = brute_lines(rows, RATIO, 3, copies=False)
    kept = set(brute_kept([r[:2] for r in rows]))
    rows = [r for r in rows if r[0] in kept]
    items = [("".join(c if c.isalnum() else " " for c in r.text.lower())).split() for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").collect()]

    def clean(text):
        words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        held = set(words)
        return all(len(held.intersection(i)) < 0.5 * len(set(i)) or brute_distance(i, words)[0] > int(len(i) * D.ERROR_RATE) for i in items)

    rows = [r for r in rows if clean(r[1])]
    assert sorted({r.doc_id for r in got}) == sorted(r[0] for r in rows)
    check_packing(got, [r[1] for r in rows], P.SEQUENCE)


NAMES = ("site", "__site", "drop", "__drop", "here", "__here", "row", "__row", "sketch", "__fingerprint", "language", "__language", "node", "keys", "host", "cell", "root")


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in NAMES})
    docs = docs.union(docs.where("doc_id < 20")).union(docs.where("doc_id = 3").withColumns({c: F.lit(None).cast(t) for c, t in docs.dtypes}))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert all(r[n] in (f"{n}{r.doc_id}", None) for r in out.collect() for n in NAMES), name
    empty = docs.limit(0)
    assert all(stage(spark, empty, SF).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_unlabelled_corpus_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, docs, SF).count() == docs.count()


def test_stage_tables_are_deleted(spark, tmp_path):
    from marketlake.llm.shared import shared_folder

    before = set(glob.glob(f"{shared_folder(spark)}/marketlake/pipeline-*"))
    corpus_pipeline.run(spark, SF).count()
    left = set(glob.glob(f"{shared_folder(spark)}/marketlake/pipeline-*")) - before
    assert [p.split("pipeline-")[1].split("-")[0] for p in left] == ["decontamination"]


class Reader(HTMLParser):
    """The article of a page by Python's own parser; blocks end at h1 and p tags."""

    def __init__(self):
        super().__init__()
        self.inside, self.out = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1"):
            self.out.append("")
        elif tag == "br":
            self.out[-1] += " "

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("p", "h1"):
            self.out.append("")

    def handle_data(self, data):
        if self.inside:
            self.out[-1] += data


def test_pages_against_another_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        reader = Reader()
        reader.feed(r.html or "")
        reader.close()
        want[r.page_id] = "\n".join(t for t in (" ".join(x.split()) for x in reader.out) if t)
    got = {r.page_id: r.text for r in H.extract_pages(pages).collect()}
    assert got == want
