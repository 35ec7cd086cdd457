import hashlib
import zlib

from scorespark.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(digests, fan=16):
    out = [list(digests)]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][k : k + fan]) for k in range(0, len(out[-1]), fan)])
    return out


def steps(tree, place, fan=16):
    for level in tree[:-1]:
        start = place // fan * fan
        yield level[start:place], level[place + 1 : start + fan]
        place //= fan


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, text):
    return H(field(r["doc_id"]), field(r["source"]), field(r["lang"]), field(r["n_chars"]), field(text))


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    by_source = {}
    for r in rows:
        leaf = leaf_of(r, r["text"])
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        by_source.setdefault(r["source"], []).append((r["doc_id"], leaf, leaf_of(r, lowered(r["text"])) if hit else leaf))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by_source[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    trees = {s: levels([x[1] for x in by_source[s]]) for s in order}
    top = levels([trees[s][-1][0] for s in order]) if order else None
    out = []
    for k, s in enumerate(order):
        for place, (doc_id, leaf, claim) in enumerate(by_source[s]):
            at, kin = claim, []
            for before, after in [*steps(trees[s], place), *steps(top, k)]:
                at = H(*before, at, *after)
                kin += [*before, *after]
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], H(*kin), at, at == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows(docs):
    rows = merkle.verified(merkle.manifest(docs, claim=merkle.lower_cased()))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in rows.select(*names).collect()), key=str)


def test_equals_brute_force_on_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    got = manifest_rows(docs)
    assert got == brute(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_aligned_blocks_give_the_same_tree(spark):
    rows, sizes = [], [1, 2, 15, 16, 17, 255, 256, 257, 273, 4097]
    for n in sizes + [1] * 300:
        first = len(rows)
        rows += [{"doc_id": first + k, "text": f"Text {k}", "lang": "en", "source": f"{n} {first}", "n_chars": k} for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert manifest_rows(docs) == brute(rows)


def test_edge_rows(spark):
    rows = [
        {"doc_id": d, "text": t, "lang": lang, "source": s, "n_chars": n}
        for d, t, lang, s, n in [
            (1, None, None, None, None), (2, "", "en", "", 0), (None, "A", "en", "é", 1), (None, "B", "en", "é", 1),
            (5, "Same", "en", "z", 4), (5, "Same", "en", "z", 4), (5, "Other", "en", "z", 5), (-5, "X" * 300_000, "de", "Z", 3),
            (10, "É Ä capitals", "fr", "\U0001f600", 12), (0, "ZERO", "en", "￮", 4),
        ]
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    assert manifest_rows(docs) == brute(rows)
    wide = docs.selectExpr("*", "1 as leaf", "2 as tree", "3 as place", "4 as claim", "5 as block")
    assert manifest_rows(wide) == brute(rows)
    assert manifest_rows(docs.limit(0)) == []


def test_witness_grows_with_later_siblings():
    appender = merkle.Appender(4)
    leaf = appender.append("a")
    assert [n.digest for n in leaf.run] == ["a"] and leaf.above is None
    for d in "bcd":
        appender.append(d)
    assert leaf.above.digest == H("a", "b", "c", "d") and leaf.above.run == [leaf.above]
    appender.append("e")
    root = appender.finish()
    path = merkle.witness(leaf, {id(root): []}, [])
    assert path == [("", "bcd"), ("", H("e"))]
    assert H(H("a", "b", "c", "d"), H("e")) == root.digest
