"""Small tables with every odd case, and brute-force versions."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}
#: Columns besides the document's own, with names that operators use inside.
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, _t long, _k string, score double, c int, token string"


def words(text):
    return WORD.findall((text or "").translate(LOW))


def odd_texts(seed=1, n=40):
    r = random.Random(seed)
    vocab = [f"w{r.randrange(10**6)}" for _ in range(300)]
    base = [" ".join(r.choice(vocab) for _ in range(r.randrange(30, 120))) for _ in range(n // 2)]
    out = [None, "", "   \n\t ", "one", "One two", "é ü ß \U0001f600 Ünï", "x" * 20_000, "word " * 3000]
    for b in base:
        out.append(b)
        w = b.split(" ")
        w[r.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    passage = "\n" + " ".join(vocab[:60]) + "\n"
    out += [base[0] + passage + base[1], passage.strip(), base[2] + passage + base[3], base[0], base[0], "#".join(vocab[:40])]
    return out


def odd_documents(spark, seed=1):
    texts = odd_texts(seed)
    rows = [(i, t, ["en", "fr", None, "xx"][i % 4], [f"s{i % 5}", None][i % 7 == 0], None if i % 6 == 0 else 1, i, "k", 0.5, 1, "t") for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (None, texts[10], "en", "s1", 3, 1, "k", 0.5, 1, "t"), (None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, EXTRA), rows


def no_documents(spark):
    return spark.createDataFrame([], EXTRA)


def components(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_units(rows, unit, min_words, min_run, window=0):
    """Words left by brute force: units seen before in runs of ``min_run`` words, and windows of words seen before."""
    stop = {"line": r"\n", "paragraph": r"\n[ \t-\r]*\n", "clause": r"\n|(?<=[.!?,;:])(?=[ \t-\r])"}[unit]
    windows, seen, out = {}, set(), {}
    for key, text in rows:
        w, gone, at, run = words(text), set(), 0, []
        for part in [*re.split(stop, text or ""), None]:
            mine = tuple(words(part)) if part is not None else ()
            if part is None or len(mine) >= min_words and mine not in seen:
                if sum(len(r) for r, old in run if old) >= min_run:
                    gone |= set(range(run[0][0][0], run[-1][0][-1] + 1))
                run = []
            elif len(mine) >= min_words:
                run.append((range(at, at + len(mine)), True))
            if len(mine) >= min_words:
                seen.add(mine)
            at += len(mine)
        for p in range(len(w) - window + 1 if window else 0):
            f = windows.setdefault(tuple(w[p : p + window]), (key, p))
            if f != (key, p):
                gone |= set(range(max(p, f[1] + window) if f[0] == key else p, p + window))
        out[key] = [x for i, x in enumerate(w) if i not in gone]
    return out
