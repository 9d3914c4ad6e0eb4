"""Small documents with every awkward case: nulls, empties, copies, repeated rows, long texts."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, rank int"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def rows():
    rng = random.Random(4)
    texts = [None, "", " \n\t ", "one two", "One Two", "a b c d", "Ünïcode ß 🎉 é", "same line here of some words more and more ten\nx"]
    texts += ["\n".join(prose(rng, rng.randrange(1, 30)) for _ in range(rng.randrange(1, 8))) for _ in range(20)]
    base = prose(rng, 200)
    texts += [base] * 6 + [base.upper()]
    for _ in range(45):  # near copies, more than a small bucket holds
        words = base.split()
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    block = "\n".join(prose(rng, 12) for _ in range(5))
    texts += [prose(rng, 20) + "\n" + block, block + "\n" + prose(rng, 9), block, prose(rng, 3) + "\n\n" + block.replace("\n", " \n", 1)]
    texts += ["q w\nq w\nq w\nq w\nq w", "t u\nq w\nq w", prose(rng, 3000), "x" * 5000]
    out = [(i * 3, t, ("en", "de", None)[i % 3], ("a", "b", None, "é")[i % 4], len(t or ""), "clash", i) for i, t in enumerate(texts)]
    return out + [out[30], out[5], (None, "no id here at all today", "en", "a", 3, "clash", 1), (None, None, None, None, None, None, None)]


def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
