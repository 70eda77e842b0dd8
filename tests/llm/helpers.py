import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, source string"


def words(text):
    return WORD.findall(text or "")


def random_texts(n, seed=0, vocabulary=30, longest=60):
    rng = random.Random(seed)
    vocab = [rng.choice(("ab", "Ça", "x|", "the", "é", "Zz9")) + str(i) for i in range(vocabulary)]
    gaps = (" ", " ", " ", "\n", "  ", "\t")
    texts = ["".join(rng.choice(vocab) + rng.choice(gaps) for _ in range(rng.randrange(longest))) for _ in range(n)]
    # passages that repeat, within and across texts
    passage = " ".join(rng.choice(vocab) for _ in range(20))
    for i in range(0, n, 4):
        texts[i] = texts[i] + " " + passage + "\n" + (passage if i % 8 else "")
    return texts + [None, "", " \n\t", texts[0], texts[0]]


def frame(spark, texts, first=0):
    rows = [(i + first, t, f"s{i % 3}" if i % 7 else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC).repartition(3)


def collected(df):
    return {r["doc_id"]: r for r in df.collect()}
