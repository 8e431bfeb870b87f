"""Each operator against a plain statement of its rule, and its defined results for odd input."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import best_fit_packing, chat_formatting, html_extraction, line_dedup, quality_rules, registry, suffix_dedup, topk_search

D = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "en", None if i % 4 == 3 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_texts():
    rnd = random.Random(3)
    prose = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "épsilon", "日本"]) + str(rnd.randrange(400)) for _ in range(300))
    near = prose.replace("alpha", "omega", 2)
    line = "this very line stands in more than one document of the set"
    return [
        None, "", "   \n\t", "x", prose, near, prose, f"{line}\n{prose[:400]}\n{line}", f"own words here {line}\nend", prose * 40, "a  b\n c <|endoftext|> d",
        line, line.replace("very", "same"), line + " indeed", "tab\tand\x0bodd\x1fspace here　too", "the " * 200,
    ]


def clashing(df):
    return df.withColumns({c: F.lit(1) for c in ("_d", "_th", "gone", "h", "no", "kept", "copies", "size", "_rest", "n_lines", "d", "fp", "label", "_k", "_rn", "_verdict")})


# chat formatting


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "<\\/s>", "", "日本\n</s>", "[[INST]INST]", None]
    rows = [(c, t, r, texts[(c + t) % len(texts)]) for c in range(8) for t, r in enumerate(["system", "user", "assistant", "user", "assistant", "tool"][: c % 6 + 1])]
    rows += [(None, None, None, None), (50, 1, "assistant", "x"), (50, 1, "assistant", "x"), (51, 0, "user\n[/INST]", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("example", F.lit(1))
    by: dict = {}
    for c, t, r, x in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        by.setdefault(c, []).append((r or "", x or ""))
    out = chat_formatting.format_chats(df).collect()
    for c, turns in by.items():
        own = sorted((r for r in out if r["conv_id"] == c), key=lambda r: r["example"])
        assert chat_formatting.parse(own[-1]["text"]) == turns
        replies = [chat_formatting.unescape(r["text"][r["loss_start"] : r["loss_end"]]) for r in own]
        assert "".join(replies) == "".join(x for r, x in turns if r == "assistant")
        for a, b in zip(own, own[1:]):
            assert b["text"].startswith(a["text"])
    digest = {r["conv_id"]: r for r in chat_formatting.digest(chat_formatting.format_chats(df)).collect()}
    for c, turns in by.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert digest[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (digest[c]["n_turns"], digest[c]["loss_chars"], digest[c]["loss_sha256"]) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_formatting.digest(chat_formatting.format_chats(df.limit(0))).count() == 0


def test_long_conversation(spark):
    """A thousand turns, some of them long: every prefix is there, and the digest is that of the turns."""
    rnd = random.Random(7)
    turns = [(7, k, ("user", "assistant")[k % 2], "x" * rnd.randrange(40) + ("</s>" if k % 9 == 0 else "") + ("y" * 50_000 if k == 500 else "")) for k in range(1000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = chat_formatting.format_chats(df)
    assert out.count() == 500
    one = chat_formatting.digest(out).first()
    loss = "".join(t for _, _, r, t in turns if r == "assistant")
    assert (one["n_turns"], one["loss_chars"], one["loss_sha256"]) == (1000, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert one["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest()


# HTML


def test_html_tables(spark):
    rows = spark.read.parquet(f"{D}/pages.parquet").collect()
    got = {r["page_id"]: r for r in registry.QUERIES["op2_html_extraction"](spark, D).collect()}
    assert len(got) == len(rows)
    for r in rows:
        body = r["html"][r["html"].index("<article>") : r["html"].index("</article>")]
        want = "\n".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", s)).split()) for s in re.split(r"<p>|</p>|</?h1>", body)) if x)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"]) == (want, len(want))


def test_html_loose_pages(spark):
    menu = "<div>Home of all the best news that anyone could ever want to read today</div>"
    pages = [
        (0, "http://h.org/a", f"<body>{menu}<p>One &amp; <b>only</b>\n text</p><div class='comments'>no</div></body>"),
        (1, "http://h.org/b", f"<body>{menu}<p>Another&nbsp;one<p>Two<ul><li>x<li>y</ul></body>"),
        (2, "http://h.org/b", f"<body>{menu}<p>Another&nbsp;one<p>Two<ul><li>x<li>y</ul></body>"),
        (3, None, None), (4, "odd", "<p class=\"x>"), (5, "http://g.org", "<script>if(a<b){'</p>'}</script><p>a<!-- <p>no</p> -->b</p><footer>f</footer>"),
        (7, "http://h.org/c", f"<body>{menu}<p>A third one</p></body>"),
        (6, "http://g.org", "<article><header><h1>T</h1></header><p>q</p><aside>no</aside><form>no</form></article><p>out</p>"), (None, "", "plain &lt;text&gt;"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {r["page_id"]: r["text"] for r in html_extraction.extract(df).collect()}
    assert got == {0: "One & only text", 1: "Another one\nTwo\nx\ny", 2: "Another one\nTwo\nx\ny", 3: "", 4: "", 5: "ab", 6: "T\nq", 7: "A third one", None: "plain <text>"}
    many_chunks = {r["page_id"]: r["text"] for r in html_extraction.extract(df, chunk_bytes=1).collect()}
    assert many_chunks == got
    assert html_extraction.extract(df.limit(0)).count() == 0


def test_html_long_and_repeated_pages(spark):
    """A page of some megabytes, and rows that repeat a page_id with the same and with another html."""
    long = "<article>" + "".join(f"<p>word{i} {'x' * 50}</p>" for i in range(40_000)) + "</article>"
    rows = [(1, "http://a.org", long), (2, "http://a.org", "<article>a</article>"), (2, "http://a.org", "<article>a</article>"), (2, "http://a.org", "<article>b</article>")]
    got = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(r["text"] for r in got if r["page_id"] == 2) == ["a", "a", "b"]
    assert next(r["text"] for r in got if r["page_id"] == 1) == "\n".join(f"word{i} {'x' * 50}" for i in range(40_000))


def test_html_marks_in_articles(spark):
    """Class and id words that only sound like menus stay; those that are nothing else go."""
    page = """<article><h1 id="comments">A</h1><h2 id="related-work">B</h2><p class="social-science">C</p><div class="ad-hoc">D</div>
      <span class="share-price">E</span><div class="comment-list">no</div><div id="comments">no</div><div class="x share-buttons">no</div><p>F</p></article>"""
    df = spark.createDataFrame([(1, None, page)], "page_id long, url string, html string")
    assert html_extraction.extract(df).first()["text"] == "A\nB\nC\nD\nE\nF"


def test_html_host_strings_by_brute_force(spark):
    """Blocks of articles and words of pages without one against a search of all strings of a host's pages."""
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    notices = [say(12), say(9), say(3)]
    pages = []
    for k in range(40):
        host = "a.org" if k % 3 else "b.org"
        own = [say(rnd.randint(4, 30)) for _ in range(3)]
        quote = [notices[1]] if k % 5 == 0 else []  # on a fifth of the pages: stays
        if k % 3:
            parts = [notices[0], own[0], *quote, own[1], notices[2], own[2]]
            pages.append((k, f"http://{host}/{k}", "<article>" + "".join(f"<p>{p}</p>" for p in parts) + "</article>", host, "a", parts))
        else:
            parts = [f"{own[0]} {notices[0]} {own[1]}", *quote, own[2]]
            pages.append((k, f"http://{host}/{k}", "".join(f"<p>{p}</p>" for p in parts), host, "l", parts))
    pages.append((40, pages[1][1], pages[1][2].replace("<article>", "<nav>x</nav><article>"), *pages[1][3:]))  # a copy under another menu
    run, share = html_extraction.RUN, html_extraction.SHARE
    grams = lambda ws: [tuple(ws[i : i + run]) for i in range(len(ws) - run + 1)]
    seen: dict = {}
    total: dict = {}
    for _, _, _, host, kind, parts in {tuple(p[5]): p for p in pages}.values():
        total[host] = total.get(host, 0) + 1
        for s in set(parts) if kind == "a" else set(grams(" ".join(parts).split())):
            seen[host, kind, s] = seen.get((host, kind, s), 0) + 1
    often = {x for x, n in seen.items() if n >= html_extraction.MIN_PAGES and n >= share * total[x[0]]}
    want = {}
    for k, _, _, host, kind, parts in pages:
        if kind == "a":
            want[k] = "\n".join(p for p in parts if (host, kind, p) not in often)
            continue
        flat = [(w, b) for b, p in enumerate(parts) for w in p.split()]
        cover = set()
        for i, g in enumerate(grams([w for w, _ in flat])):
            if (host, kind, g) in often:
                cover |= set(range(i, i + run))
        left = ["", *[" ".join(w for i, (w, b) in enumerate(flat) if b == x and i not in cover) for x in range(len(parts))]]
        want[k] = "\n".join(x for x in left if x)
    df = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extraction.extract(df).collect()}
    assert got == want
    assert {x[1] for x in often} == {"a", "l"}
    assert all(notices[1] in want[p[0]] for p in pages if notices[1] in p[5])


def test_suffix_ranks():
    t = np.array([1, 2, 3, 1, 2, 3, 1, 2, 4], np.uint64)
    r = html_extraction.suffix_ranks(t, 4)
    same = {(i, j) for i in range(9) for j in range(i) if r[i] == r[j]}
    assert same == {(i, j) for i in range(9) for j in range(i) if list(t[i : i + 4]) == list(t[j : j + 4])}


# suffix dedup


def brute_suffix(rows, length=50):
    seen: dict[bytes, int] = {}
    for d, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            seen[w] = min(seen.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] < d:
                gone[p : p + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_dedup_odd(spark):
    texts = odd_texts()
    df = clashing(docs_of(spark, texts).unionByName(docs_of(spark, texts[4:6], ids=[4, 5])))
    got = sorted(map(tuple, suffix_dedup.dedup(df).collect()))
    assert got == brute_suffix([*enumerate(texts), (4, texts[4]), (5, texts[5])])
    assert suffix_dedup.dedup(df.limit(0)).count() == 0
    assert got == sorted(map(tuple, suffix_dedup.dedup(df, hot_runs=1).collect()))  # every suffix on its own
    nulls = docs_of(spark, [texts[4], texts[4]], ids=[7, None])
    assert {r["doc_id"]: r["n_removed"] for r in suffix_dedup.dedup(nulls).collect()} == {7: 0, None: len(texts[4].encode())}


def test_suffix_dedup_long_texts(spark):
    """Texts of several chunks, whose shared strings lie across the chunks' edges."""
    rnd = random.Random(10)
    part = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared, chunk = part(3000), 1 << 18
    long = part(chunk - 1500) + shared + part(chunk - 3100) + shared + part(2000)
    texts = [long, part(400) + shared[:1700] + part(300), shared[1000:], long[chunk - 60 : chunk + 60], long[: chunk + 10]]
    got = sorted(map(tuple, suffix_dedup.dedup(docs_of(spark, texts)).collect()))
    assert got == brute_suffix([*enumerate(texts)])


def test_suffix_dedup_hot_passage(spark):
    """One passage in every text, between bytes of the text's own: its edges make one minimiser with many contexts."""
    rnd = random.Random(13)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(90))
    own = lambda: "".join(rnd.choice("ijklmnop ") for _ in range(60))
    texts = [own() + passage[: rnd.randint(60, 90)] + own() for _ in range(300)]
    for hot_runs in (3, 50, 10**6):
        assert sorted(map(tuple, suffix_dedup.dedup(docs_of(spark, texts), hot_runs=hot_runs).collect())) == brute_suffix([*enumerate(texts)])


def test_suffix_dedup_tables(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, registry.QUERIES["op3_suffix_dedup"](spark, D).collect()))
    assert got == brute_suffix(rows)


def test_deep_shallow_orders():
    rnd = np.random.default_rng(1)
    w = rnd.integers(0, 2, (400, 50)).astype(np.uint8)
    w[50:150, :45] = w[0, :45]
    w[200:260] = w[3]
    order, same = suffix_dedup.deep_shallow(w)
    rows = [w[i].tobytes() for i in order]
    assert rows == sorted(x.tobytes() for x in w)
    assert list(same[1:]) == [a == b for a, b in zip(rows, rows[1:])]


# top k


def test_topk_odd(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rnd.normal(size=6)]) for i in range(400)]
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (500, []), (600, [0.5]), (7, rows[7][1]), (None, rows[3][1]), (700, [1e30] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0))
    got = {}
    for r in topk_search.top_k(df, F.col("vec_id") % 100 == 0, shard_rows=90).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ok = [(i, [int(np.floor(1024 * np.float64(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    lim = 2**63 - 1
    for q, v in ok:
        if q is not None and q % 100 == 0:
            scored = [(max(-lim - 1, min(lim, sum(a * b for a, b in zip(v, w)))), i) for i, w in ok if i != q]
            best = sorted(scored, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:10]
            assert sorted(got[q]) == [(k + 1, i, s) for k, (s, i) in enumerate(best)]
    assert topk_search.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_topk_two_vectors_under_one_id(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [3.0, 0.0]), (2, [0.0, 2.0]), (3, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r["vec_id"], r["score"] >> 20) for r in topk_search.top_k(df, F.col("vec_id") % 100 == 0, k=2).collect())
    assert got == [(1, 1, 3), (1, 2, 2), (2, 3, 1), (2, 3, 1)]


# quality rules


def brute_quality(text):
    words = WORDS.findall(text or "")
    spots: dict = {}
    for i in range(len(words) - 7):
        spots.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {j for at in spots.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit), failed


def brute_kept(text):
    """The method's verdict from its limits, by plain loops."""
    words = WORDS.findall(text or "")
    chars = sum(map(len, words))
    if brute_quality(text)[5]:
        return False
    for n in range(5, 11):
        spots: dict = {}
        for i in range(len(words) - n + 1):
            spots.setdefault(tuple(words[i : i + n]), []).append(i)
        inside = {j for at in spots.values() if len(at) > 1 for i in at for j in range(i, i + n)}
        if sum(len(words[j]) for j in inside) > (0.5 - 0.02 * n) * chars + 1e-9:
            return False
    lines, seen, dup, dup_chars = 0, set(), 0, 0
    for line in text.split("\n"):
        own = WORDS.findall(line)
        if own:
            lines += 1
            dup += line in seen
            dup_chars += sum(map(len, own)) * (line in seen)
            seen.add(line)
    return dup <= 0.4 * lines and dup_chars <= 0.4 * chars


def test_quality_verdict_on_odd_texts():
    """White space beyond ASCII is part of a word, in repeated lines as elsewhere."""
    rnd = random.Random(4)
    odd = ["\u00a0", "\u3000", "\x85", "\x1c", " ", "\t", "\x0b"]
    texts = odd_texts()
    for _ in range(300):
        line = lambda: rnd.choice(odd).join("w" * rnd.randint(1, 4) + str(rnd.randrange(90)) for _ in range(rnd.randint(1, 9)))
        own = [line() for _ in range(rnd.randint(2, 12))]
        texts.append("\n".join(own + rnd.choices(own, k=rnd.randint(0, 12))))
    texts.append("\n".join(["aaaa\u00a0" * 10, "b c d e f g h i j k", "aaaa\u00a0" * 10, "l m n o p q r s t u v w x y"]))
    verdicts = [(quality_rules.judge(t)[6], brute_kept(t)) for t in texts]
    assert [a for a, _ in verdicts] == [b for _, b in verdicts]
    assert 20 < sum(a for a, _ in verdicts) < len(texts) - 20


def test_quality_rules(spark):
    texts = odd_texts()
    got = {r["doc_id"]: tuple(r)[1:7] for r in quality_rules.apply_rules(docs_of(spark, texts)).collect()}
    assert got == {i: brute_quality(t) for i, t in enumerate(texts)}
    kept = quality_rules.keep_good(clashing(docs_of(spark, texts)))
    assert kept.columns == clashing(docs_of(spark, texts)).columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {4, 5, 6} <= ids and not ids & {0, 1, 2, 3, 9, 15}
    assert quality_rules.apply_rules(docs_of(spark, texts).limit(0)).count() == 0


def test_quality_tables(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    for r in registry.QUERIES["op7_quality_rules"](spark, D).collect():
        assert tuple(r)[1:7] == brute_quality(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_long_text_slices():
    text = ("wörd " * 70_000 + "x" * 300_000 + " end") * 2
    words = WORDS.findall(text)
    hashes, sizes = quality_rules.word_hashes(text.encode())
    assert len(hashes) == len(words) and list(sizes) == [len(w) for w in words]


# packing


def token_ids(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(best_fit_packing.default_tokenizer()).encode(text or "", add_special_tokens=False).ids, 2]


def check_packing(rows, texts, capacity=1024):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(best_fit_packing.default_tokenizer())
    by: dict = {}
    room: dict = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
        room.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, text in texts.items():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(by[d], key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(own):
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(part))
            assert r["length"] == capacity or k == 0
            at += r["length"]
        assert at == len(ids)
    for spans in room.values():
        end = 0
        for a, n in sorted(spans):
            assert a == end
            end += n
        assert end <= capacity
    return sum(r["length"] for r in rows), len(room)


def test_ids_are_those_of_the_tokenizer():
    """The faster engine against the tokenizer: every kind of character in several places, joined tokens, long runs, added tokens."""
    ids = best_fit_packing.Ids(best_fit_packing.default_tokenizer())
    assert ids.fast is not None
    rnd = random.Random(6)
    points = [c for c in rnd.sample(range(0x110000), 4000) if not 0xD800 <= c < 0xE000] + list(range(0x300)) + list(range(0x2000, 0x2070)) + [0x3000, 0xFEFF]
    texts = [(lambda c: f"a{c}b {c}1{c}1 .{c}.  {c} {c}{c}x")(chr(c)) for c in points]
    tokens = [t.replace("\u0120", " ") for t in ids.tokenizer.get_vocab()]
    texts += ["".join(rnd.choice(tokens) for _ in range(rnd.randint(1, 5))) for _ in range(5000)]
    texts += ["", " ", "\n \n", "x" * 20000, " " * 300_000 + "x", "\n" * 300_000, "a <|endoftext|> b", "it's we'll I'd 'S", "1234 56", "don't\u3000go\u00a0on\u0085"]
    for text in texts:
        assert ids.text(text) == np.array(ids.whole(text), "<u4").tobytes()


def test_packing_odd(spark):
    texts = odd_texts()
    rows = best_fit_packing.pack(clashing(docs_of(spark, texts)), best_fit_packing.default_tokenizer()).collect()
    check_packing(rows, dict(enumerate(texts)))
    assert best_fit_packing.pack(docs_of(spark, texts).limit(0), best_fit_packing.default_tokenizer()).count() == 0
    small = best_fit_packing.pack(docs_of(spark, texts).coalesce(1), best_fit_packing.default_tokenizer(), capacity=64, most_open=2, part_tokens=4000, with_ids=True).collect()
    check_packing(small, dict(enumerate(texts)), 64)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in small)


def test_packing_null_and_repeated_ids(spark):
    df = docs_of(spark, ["one two", "one two", "three", "four"], ids=[5, 5, None, None])
    rows = best_fit_packing.pack(df, best_fit_packing.default_tokenizer()).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["length"]) for r in rows) == sorted((-1 if d is None else d, len(token_ids(t))) for d, t in [(5, "one two"), (5, "one two"), (None, "three"), (None, "four")])
    assert sorted(r["offset"] for r in rows)[0] == 0 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 4


def test_packing_tables(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    total, used = check_packing(registry.QUERIES["op9_best_fit_packing"](spark, D).collect(), texts)
    assert used <= -(-total // 1024) * 1.01 + 1


def test_packing_hardly_depends_on_splits(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    for n in (1, 60):
        got = best_fit_packing.pack(docs.repartition(n), best_fit_packing.default_tokenizer()).agg(F.sum("length").alias("t"), F.countDistinct("sequence_id").alias("n")).first()
        assert got["n"] <= -(-got["t"] // 1024) * 1.01 + 1


def test_packer_is_best_fit():
    """Against a list of open sequences that is searched for the fullest one with room."""
    rnd = random.Random(5)
    for most_open in (1, 2, 5, 1000):
        packer = best_fit_packing.Packer(100, most_open)
        open_: dict[int, int] = {}
        made = 0
        for _ in range(3000):
            length = rnd.choice([100, rnd.randint(1, 100), rnd.randint(1, 30)])
            seq, offset, closed = packer.place(length)
            room = [f for f in open_.values() if f >= length]
            gone = []
            if room:
                assert 100 - offset == open_[seq] == min(room)
            else:
                if len(open_) == most_open:
                    assert open_[closed[0]] == min(open_.values())
                    gone.append(closed[0])
                    del open_[closed[0]]
                assert (seq, offset) == (made, 0)
                open_[seq], made = 100, made + 1
            open_[seq] -= length
            if not open_[seq]:
                gone.append(seq)
                del open_[seq]
            assert closed == gone


# line dedup


def brute_lines(rows):
    def within(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p + (len(a) > len(b)) :] == b[p + (len(b) > len(a)) :]

    all_ = [(float("inf") if d is None else d, no, WORDS.findall(line)) for d, t in rows for no, line in enumerate(t.split("\n") if t is not None else [])]
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, None))
            continue
        me = float("inf") if d is None else d
        near = lambda v, w: v == w if min(len(v), len(w)) < 5 else within(v, w)
        kept = [line for no, line in enumerate(t.split("\n")) if not WORDS.search(line) or not any((x, k) < (me, no) and near(w, WORDS.findall(line)) for x, k, w in all_)]
        out.append((d, "\n".join(kept)))
    return sorted(out, key=repr)


def test_line_dedup_odd(spark):
    base = "one two three four five six seven"
    w = base.split()
    texts = [
        base, base, f"{base}\nshort line\nshort line", base.replace("four", "IV"), " ".join(w[:-1]), " ".join(w[1:]), f"zero {base}", base.replace("one", "I").replace("two", "II"),
        None, "", "\n\n", f"  one   two\tthree four five six seven  \n{base} eight nine", "a b c d e", "a b c d f", "a b c d", " ".join(w[:3] + ["x"] + w[3:]),
    ]
    rows = [*enumerate(texts), (0, base), (None, base), (None, "only here a b c d e f")]
    df = clashing(spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCS))
    got = line_dedup.dedup(df)
    assert got.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == brute_lines(rows)
    assert line_dedup.dedup(df.limit(0)).count() == 0


def test_line_dedup_short(spark):
    """Equal short lines go after the first; short lines one word apart and lines without words stay."""
    texts = ["Read more\nRead  more\n\nRead this\none two three four five", "Les.\nRead more\n\none two three four\none two three four six", "Les.\none two three four"]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(docs_of(spark, texts)).collect()}
    assert got == {0: "Read more\n\nRead this\none two three four five", 1: "Les.\n\none two three four", 2: ""}


@pytest.mark.parametrize("name", ["op1_chat_formatting", "op4_source_mixing", "op6_topk_search", "op7_quality_rules", "op8_jaccard_join", "op10_line_dedup"])
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    got, want = registry.QUERIES[name](spark, D).toPandas(), con.sql(registry.ORACLES[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda x: sorted(map(repr, x[cols].itertuples(index=False, name=None)))
    assert key(got) == key(want)
