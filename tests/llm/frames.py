"""Small tables with the awkward cases, and random ones."""

import random

SCHEMA = "doc_id long, text string, lang string, _id int, _text string, h1 string, fp string"


def frame(spark, rows):
    """documents-like rows (doc_id, text), with extra columns of clashing names."""
    return spark.createDataFrame([(i, t, None, 7, "x", "y", "z") for i, t in rows], SCHEMA).repartition(3)


AWKWARD = [(1, None), (2, ""), (3, "   "), (4, "a b c"), (5, "a b c"), (6, "A\tB\nC"), (7, "long " * 50_000),
           (None, "no id here"), (9, "twice"), (9, "twice"), (9, "other text, same id"), (10, "x\n\nx\n"), (11, "é" * 300)]


def random_texts(n, seed=1, words=60, size=30):
    """Texts that share words, lines and long passages."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 7))) for _ in range(words)]
    passages = [" ".join(rnd.choice(vocabulary) for _ in range(40)) for _ in range(4)]
    out = []
    for i in range(n):
        if out and rnd.random() < 0.25:
            t = out[rnd.randrange(len(out))][1]
            if rnd.random() < 0.6:
                k = rnd.randrange(len(t) + 1)
                t = t[:k] + rnd.choice(vocabulary) + t[k:]
        else:
            parts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, size))) for _ in range(rnd.randint(1, 5))]
            if rnd.random() < 0.4:
                parts.insert(rnd.randrange(len(parts) + 1), rnd.choice(passages))
            t = rnd.choice(["\n", " "]).join(parts)
        out.append((i, t))
    return out
