import duckdb
import pytest

from stayflow.llm import chat_rotation, url_trie

SF = "/root/testdata/sf0.001"


def frames(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def oracle(sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows.toArrow())
    return sorted(map(str, con.execute(sql).fetchall()))


URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.com/en/x", "http://example.com/en", "http://example.com/english/", "http://www.example.com/en/?q=/",
        "http://a.www.example.com/en/", "http://notexample.com/en/", "ftp://x.net/es/1", "http://x.net/fr/#/", "http://net", "http://net/", "http://com/",
        "http://user@Example.COM:80/en/", "x://y://z.com/", "http://.com/", "http://com./", "http://É.com/en/", "http://example.com//en/", "http://a.net/ES/"]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:n].translate({c: c + 32 for c in range(65, 91)}), rest[n:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [r for r in url_trie.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (r.host.count("."), len(r.path)), default=None)
    return (host, path, best.name if best else None, best.verdict if best else "allow")


def test_urls_match_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "<p>", "x", "y") for i, u in enumerate(URLS * 2)], "page_id long, url string, html string, host string, rule string")
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_trie.url_filter(pages, url_trie.RULES).collect()}
    assert out == {i: brute(u) for i, u in enumerate(URLS * 2)}
    assert url_trie.url_filter(pages.limit(0), url_trie.RULES).count() == 0


def test_path_segments_and_equal_rules():
    trie = url_trie.build_trie([url_trie.Rule("block", "a.com", "/x"), url_trie.Rule("allow", "a.com", "/x/y/"), url_trie.Rule("allow", "a.com", "/x/y/")])
    assert url_trie.find(trie, "a.com", "/xyz").verdict == "block" and url_trie.find(trie, "b.a.com", "/x/y/z").path == "/x/y/"
    assert url_trie.find(trie, "a.com", "/x/y").path == "/x" and url_trie.find(trie, "a.com", "") is None
    with pytest.raises(ValueError):
        url_trie.build_trie([url_trie.Rule("allow", "a.com", "no slash")])


CONV = "conv_id long, turn long, role string, text string, part string, speaker string, messages string"


def test_rotation_matches_the_sql_on_odd_rows(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", None), (1, 3, "Ana Maria", "<|im_end|> <|im_start|>x"), (1, 1, "user", "hi"),
            (2, 0, "system", "alone"), (3, 5, None, "who"), (3, 5, "b", "tie"), (3, 5, "a", "tie"), (3, None, "a", "first"), (None, 0, "u", "no id"),
            (None, 1, "v", ""), (4, 511, "u", "é"), (4, 512, "a", "next part"), (4, 513, "u", "😀")]
    df = spark.createDataFrame([(*r, "p", "s", "m") for r in rows], CONV)
    out = chat_rotation.rotate(df)
    assert frames(out) == oracle(chat_rotation.OP10_SQL, conversations=spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    one = {(r.conv_id, r.speaker): r for r in out.collect()}
    r = one[(1, "assistant")]
    assert r.dialogue.startswith("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=user\nhi") and "name=Ana_Maria\n< |im_end|>" in r.dialogue
    for r in out.collect():
        spans = [tuple(map(int, s.split(":"))) for s in r.mask_spans.split(",") if s]
        assert len(spans) == r.n_trained and all(r.dialogue[a:b].endswith("<|im_end|>") and r.dialogue[:a].endswith("<|im_start|>assistant\n") for a, b in spans)
    assert chat_rotation.rotate(df.limit(0)).count() == 0
    assert (2, None) in one and one[(2, None)].mask_spans == ""


def test_rotation_runs_no_python(spark):
    plan = chat_rotation.op10_chat_rotation(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_participants_are_joined_as_rows(spark):
    from stayflow.llm import chat_rotation

    said = spark.createDataFrame([(1, 0, f"speaker{i}", "hello") for i in range(30)] + [(2, 0, "system", "x"), (None, 0, "a", "y")],
                                 "conv_id long, turn long, role string, text string")
    out = chat_rotation.rotate(said)
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.conv_id, r.speaker): r.n_trained for r in out.collect()}
    assert got == {(1, f"speaker{i}"): 1 for i in range(30)} | {(2, None): 0, (None, "a"): 1}


def test_a_part_with_a_third_of_all_messages_is_cut_into_slices(spark):
    """Messages without a turn: one part, many slices; and one dialogue id that is null."""
    import random

    rng = random.Random(1)
    rows = [(7, None, rng.choice(["user", "bot", None]), "m%d " % i + "x" * rng.randrange(200)) for i in range(3000)]
    rows += [(None, 5, "user", "n%d" % i) for i in range(1500)] + [(i, t, "user" if t % 2 else "bot", "hi %d" % t) for i in range(100, 400) for t in range(10)]
    rows += [(7, None, "user", "y" * 9000), (7, None, "user", "m1")] * 3
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_rotation.rotate(df, chars_per_slice=5000)
    sql = chat_rotation.OP10_SQL.replace("1000000.0", "5000.0")
    assert "1000000.0" in chat_rotation.OP10_SQL and chat_rotation.CHARS_PER_SLICE == 1_000_000
    assert frames(out) == oracle(sql, conversations=df)
    sizes = [len(r.dialogue) for r in out.collect()]
    assert max(sizes) < 9000 + 2 * 5000 and len({r.slice for r in out.where("conv_id = 7").collect()}) > 60
    assert "Python" not in out._jdf.queryExecution().toString()
