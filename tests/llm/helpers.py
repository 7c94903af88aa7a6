"""Small documents with every awkward case, and readers of the smallest tables."""

import random
import string

import duckdb

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text):
    return (text or "").encode("utf-8").split()


def text_rows(limit=None):
    sql = f"select doc_id, text, source from '{SF}/documents.parquet' order by doc_id" + (f" limit {limit}" if limit else "")
    return duckdb.sql(sql).fetchall()


def awkward(seed=3, near=12):
    """(doc_id, text, source): copies, near copies, shared passages, nulls, blanks, one long text."""
    rng = random.Random(seed)
    vocab = ["w%d" % k for k in range(40)] + ["Été", "ÜBER", "naïve x", "\x1cctl", "日本"]
    draw = lambda n: [rng.choice(vocab) for _ in range(n)]
    base, passage = draw(60), draw(26)
    texts = [None, "", " \t\n", "one", "Two words", "a b c", "A B C", " ".join(base), " ".join(base), "  ".join(base).upper()]
    for _ in range(near):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        texts.append(" ".join(w))
    for _ in range(6):
        texts.append(" ".join(draw(rng.randrange(30)) + passage + draw(rng.randrange(30))))
    texts.append("\n".join([" ".join(draw(9))] * 4 + [" ".join(draw(12))]))
    texts.append(" ".join(draw(4000)) + " " + " ".join(passage))
    texts.append(" ".join(passage + passage))
    small = draw(14)
    for k in range(8):
        w = list(small)
        w[k] = "zz%d" % (k % 3)
        texts.append(" ".join(w))
    return [(k * 3, t, rng.choice(["a", "b", None]) if k % 4 else "a") for k, t in enumerate(texts)]


SCHEMA = "doc_id long, text string, source string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)
