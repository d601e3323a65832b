"""Documents that operators must take: nulls, empty and long texts, ties, repeats, extra columns."""

import random

SYLLABLES = "ka lo mi ne ru sa te vo zu fi".split()


def words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]


def texts(seed=1, n=40):
    """Made-up prose with copies, near copies and shared passages."""
    rng = random.Random(seed)
    passage = words(rng, 30)
    out = []
    for k in range(n):
        body = words(rng, rng.randint(1, 120))
        if k % 4 == 1:
            at = rng.randrange(len(body) + 1)
            body[at:at] = passage
        text = "".join(w + rng.choice([" ", " ", " ", "\n", "\t", ". "]) for w in body)
        out.append(text)
    out += [out[0], out[3], out[3] + " more", out[5].upper()]
    return out


def rows(seed=1):
    found = list(enumerate(texts(seed)))
    found += [(100, None), (101, ""), (102, " \n\t "), (103, "one"), (104, "one two"), (None, None), (None, found[1][1])]
    found += [(105, "a b c d e f g " * 3000), (106, "\U0001f600 é \x0b ü " * 20), (107, found[2][1]), (107, found[2][1]), (107, found[6][1])]
    return found


# Columns of the caller that are named like things operators make on their way.
EXTRA = ["n_words", "shard", "slot", "fp", "group", "w", "h", "score", "node", "uid", "kept", "source", "lang"]
EXTRA += ["row", "no", "rows", "hash", "first_id", "text_hash", "__id", "__none", "__hash", "__rows", "__text_hash", "__no", "__doc_id"]
EXTRA += ["__mix_place", "__mix_epoch", "__quality_w", "__quality_lines", "__quality_row", "__bucket", "item_id", "embedding"]


def documents(spark, found=None):
    found = rows() if found is None else found
    schema = "doc_id long, text string, " + ", ".join(f"{name} string" for name in EXTRA)
    data = [(i, t, *[f"{name}{k % 3}" for name in EXTRA]) for k, (i, t) in enumerate(found)]
    return spark.createDataFrame(data, schema).repartition(3)


def empty(spark):
    return documents(spark).limit(0)
