"""Small documents with every odd case, and plain definitions to hold the operators against."""

import random
import re
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, rank int, take int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng, n, start=0):
    return " ".join(f"w{rng.randrange(400)}{'.' if rng.random() < 0.1 else ''}" for _ in range(n))


def odd_documents(seed=5):
    """(doc_id, text, source): copies, near copies, shared passages, nulls, blanks, repeated rows."""
    rng = random.Random(seed)
    base = [sentence(rng, n) for n in (3, 5, 40, 80, 160, 400)]
    shared = sentence(rng, 70)
    texts = [None, "", "  \t\n ", "one", "one", "Two WORDS", "two words", "é ü 中文 字", "a" * 700]
    for text in base:
        texts += [text, text.upper(), text]
        words = text.split()
        for _ in range(6):
            edited = list(words)
            for _ in range(rng.randrange(1, 4)):
                edited[rng.randrange(len(edited))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(edited))
    texts += [sentence(rng, 20) + "\n" + shared + "\n" + sentence(rng, rng.randrange(30)) for _ in range(6)]
    texts.append(sentence(rng, 6000))
    rows = [(i, t, [None, "b", "a", "Z", "é"][i % 5]) for i, t in enumerate(texts)]
    rows += [rows[3], rows[12], (7, "another text of the same id " * 9, "b"), (None, "no id", "a")]
    return rows


def frame(spark, rows):
    """Rows as documents that have columns with names the operators use themselves."""
    full = [(i, t, "en", s, None if t is None else len(t), None, 1, 2) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def shingles(text, width=5):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def similar_groups(rows, percent=85):
    """Smallest doc_id that each doc_id reaches over similar pairs, all pairs compared."""
    sets = [(i, shingles(t)) for i, t, _ in rows if i is not None]
    links = defaultdict(set)
    for i, a in sets:
        links[i].add(i)
        for k, b in sets:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links[i].add(k)
    out = {}
    for i in sorted(links):
        if i in out:
            continue
        todo, seen = [i], {i}
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        out |= dict.fromkeys(seen, i)
    return out
