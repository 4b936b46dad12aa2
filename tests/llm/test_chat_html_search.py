import hashlib
import html
import re

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat, mtree
from tidemark.llm.html_content import extract_pages, main_text
from tidemark.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string, formatted string, c string, n int"


def test_chat_digests(spark):
    got = {r["conv_id"]: r for r in QUERIES["op2_chat"](spark, SMALL).collect()}
    turns = pd.read_parquet(f"{SMALL}/conversations.parquet").sort_values(["conv_id", "turn"])
    said = "</s>[INST] ok [/INST]"
    extra = pd.DataFrame({"conv_id": [-1, -1], "turn": [0, 1], "role": ["user", "assistant"], "text": [said, said]})
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for own, part in pd.concat([turns, extra]).groupby("conv_id"):
        text = "".join(f"{r}\n{t}\n" for r, t in zip(part.role, part.text))
        loss = "".join(t for r, t in zip(part.role, part.text) if r == "assistant")
        r = got.pop(own)
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(part), sha(text), len(loss), sha(loss))
    assert not got


def test_chat_odd_rows(spark):
    rows = [
        (1, 0, "user", None, "x", "y", 1), (1, 1, None, "hi", "x", "y", 1), (1, 1, None, "hi", "x", "y", 1), (1, None, "assistant", "", "x", "y", 1),
        (None, 2, "assistant", "<s> \\ </s> é", "x", "y", 1), (None, 1, "[ROLE] a\n", "[/ROLE]\n", "x", "y", 1), (2, 0, "tool", "漢" * 5000, "x", "y", 1),
    ]
    got = {r["conv_id"]: r for r in chat.format_conversations(spark.createDataFrame(rows, TURNS)).collect()}
    assert chat.read_turns(got[1]["formatted"]) == [("assistant", ""), ("user", ""), ("", "hi"), ("", "hi")]
    assert chat.read_turns(got[None]["formatted"]) == [("[ROLE] a\n", "[/ROLE]\n"), ("assistant", "<s> \\ </s> é")]
    assert chat.read_loss(got[None]["formatted"], got[None]["loss_spans"]) == "<s> \\ </s> é"
    assert chat.read_turns(got[2]["formatted"]) == [("tool", "漢" * 5000)]
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\\[INST]"]), st.text(alphabet="<>s/[]INTROLEY\\ \né", max_size=30)), min_size=1, max_size=6))
def test_escaping_is_reversible(turns):
    import pyarrow as pa

    roles, texts = pa.array([r for r, _ in turns]), pa.array([t for _, t in turns])
    out, spans = chat.assemble(np.array([0, len(turns)]), roles, texts)
    formatted = out[0].as_py()
    assert chat.read_turns(formatted) == turns
    assert chat.read_loss(formatted, spans[0]) == "".join(t for r, t in turns if r == "assistant")
    inner = [formatted[s["start"] : s["end"]] for s in spans[0]]
    assert not any(c in part for part in inner for c in chat.CONTROLS)


def test_html_query_on_pages(spark):
    pages = pd.read_parquet(f"{SMALL}/pages.parquet")
    got = {r["page_id"]: r for r in QUERIES["op10_html"](spark, SMALL).collect()}
    for row in pages.itertuples():
        article = re.search(r"<article>(.*)</article>", row.html, re.DOTALL)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article))
        text = "\n".join(b for b in blocks if b)
        assert got[row.page_id]["text"] == text and got[row.page_id]["n_chars"] == len(text)


LONG = "A sentence of the story, with commas, and an end. " * 4


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""), ("", ""), ("just text &amp; more", "just text & more"), ("<p>a<p>b</b><br>c", "a\nb\nc"), ("<nav>menu</nav>", ""),
        (f"<header>Site</header><div class='content'><h1>Title</h1><p>{LONG}</p><p>Short.</p></div><div class=sidebar><p>{LONG}</p></div>"
         f"<div id='comments'><p>{LONG}</p></div><form>Name <input></form><footer>f</footer>", f"Title\n{LONG.strip()}\nShort."),
        (f"<main><p>x  \n y&nbsp;z</p><aside>{LONG}</aside><script>a<b</script><style>p{{}}</style><!-- <p>no</p> --></main>", "x y z"),
        (f"<article><header><h1>T</h1></header><p>One <b>bo</b>ld <a href='>'>link</a>.</p><ul><li>i<li>j</ul><div class='cookie-notice'>c</div></article><p>{LONG}</p>",
         "T\nOne bold link.\ni\nj"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<article><p>&lt;p&gt; &eacute; &#8364;</p></article>", "<p> é €"),
        ("<div class='has-sidebar overflow-hidden'><p>kept.</p></div>", "kept."), ("<p hidden>no</p><p>yes</p>", "yes"),
    ],
)
def test_html_cases(page, text):
    assert main_text(page) == text


def test_html_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    rows = [(1, None, None, "x", 1), (None, "u", "<p>a</p>", "x", 1), (2, "v", "<div>" * 3000 + "deep" + "<p>x" * 3000, "x", 1), (2, "v", "<p>a</p>", "x", 1)]
    got = extract_pages(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 4 and sorted(r["n_chars"] for r in got)[:3] == [0, 1, 1]
    assert extract_pages(spark.createDataFrame([], schema)).count() == 0


def plain_top(rows, k=5):
    out = {}
    for q, v in rows:
        if q is not None and q % 2 == 0:
            scored = [(float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v)]
            scored.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
            out[q] = [(i, s) for s, i in scored[:k]]
    return out


@pytest.mark.parametrize("tree_rows,block_rows,page", [(8192, 512, 48), (40, 7, 4)])
def test_search_equals_brute_force(spark, tree_rows, block_rows, page):
    rng = np.random.default_rng(3)
    rows = [(k, rng.integers(-5, 6, 6).astype(float).tolist()) for k in range(300)]
    rows += [(k, [1.0] * 6) for k in range(300, 420)] + [(500, [2.0, 3.0]), (502, [1.0, 1.0]), (None, [50.0] * 6)]
    bad = [(600, None), (601, [1.0, None]), (602, [float("nan")] * 6), (603, [float("inf")] * 6)]
    df = spark.createDataFrame([(k, v, 1, 2.0) for k, v in rows + bad], "vec_id long, embedding array<double>, rank int, score double")
    rules = mtree.TreeRules(tree_rows=tree_rows, block_rows=block_rows, page=page)
    from pyspark.sql import functions as F

    got = {}
    for r in sorted(mtree.top_products(df, F.col("vec_id") % 2 == 0, rules=rules).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == plain_top(rows)
    assert mtree.top_products(df.limit(0), F.col("vec_id") % 2 == 0).count() == 0


def test_stored_distances_rule_entries_out():
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 100, (40, 8))
    vectors = np.concatenate([c + rng.normal(0, 1, (100, 8)) for c in centres])
    vectors = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    tree, met = mtree.MTree(vectors, 32, 1), []

    def counted(rows, products):
        met.extend(rows.tolist())
        return float(np.sqrt(((vectors[met] - vectors[7]) ** 2).sum(axis=1)).min())

    tree.search(vectors[7], counted, 1e-6)
    assert 7 in met and len(met) < 400
