import random
from collections import defaultdict

import pytest
from conftest_llm import as_docs, prose

from aerolith.llm import paragraphs


def slow(rows, least=20, threshold=0.8):
    met = []
    for n, (i, text) in enumerate(rows):
        for k, line in enumerate((text or "").split("\n")):
            w = line.encode().lower().split()
            if i is not None and len(w) >= least:
                met.append((i, k, frozenset(tuple(w[x : x + 5]) for x in range(len(w) - 4)), n))
    root = list(range(len(met)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(met)):
        for b in range(a):
            common = len(met[a][2] & met[b][2])
            if common >= threshold * (len(met[a][2]) + len(met[b][2]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    keep, gone = {}, defaultdict(set)
    for k, m in enumerate(met):
        keep[find(k)] = min(keep.get(find(k), m[:2]), m[:2])
    for k, m in enumerate(met):
        if keep[find(k)] != m[:2]:
            gone[m[3]].add(m[1])
    return [(i, len(gone[n]), "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone[n])) for n, (i, t) in enumerate(rows)]


def test_matches_brute_force(spark, hard_rows, same_rows):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    passages = [prose(rng, 60, words) for _ in range(5)]

    def edited(p):
        w = p.split(" ")
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = rng.choice(words)
        return " ".join(w)

    rows = hard_rows + [(500 + k, "\n".join([prose(rng, 30, words), edited(rng.choice(passages)), "short line", prose(rng, 25, words)])) for k in range(60)]
    found = paragraphs.remove_repeated_paragraphs(as_docs(spark, rows))
    same_rows(found.select("doc_id", "n_removed", "kept").collect(), slow(rows))


def slow_registered(rows):
    """Blocks, then the lines that are left, of any length, every pair compared: as the registered query has it."""

    def later(met, compared):
        """Occurrences (row, place) but the first of each component; met: (row, id, place, words)."""
        root = list(range(len(met)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        sets = [frozenset(tuple(m[3][x : x + 5]) for x in range(len(m[3]) - 4)) for m in met]
        for a in range(len(met)):
            for b in range(a):
                common = len(sets[a] & sets[b])
                near = sets[a] and sets[b] and compared[a] and compared[b] and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common)
                if met[a][3] == met[b][3] or near:
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
        keep = {}
        for k, m in enumerate(met):
            keep[find(k)] = min(keep.get(find(k), (m[1], m[2])), (m[1], m[2]))
        return {(m[0], m[2]): keep[find(k)][0] for k, m in enumerate(met) if keep[find(k)] != (m[1], m[2])}

    words = lambda line: line.encode().lower().split()
    sentence = lambda line: len(words(line)) >= 5 and words(line)[-1][-1:] in (b".", b"!", b"?", b":", b";")
    blocks, compared, size = [], [], {}
    for n, (i, text) in enumerate(rows):
        lines, at = (text or "").split("\n"), 0
        while at < len(lines):
            to = at
            while to < len(lines) and words(lines[to]):
                to += 1
            if to > at:
                if i is not None:
                    blocks.append((n, i, at, [w for x in lines[at:to] for w in words(x)]))
                    compared.append(to - at == 1 or not all(map(sentence, lines[at:to])))
                size[n, at] = to - at
            at = max(to, at + 1)
    gone = later(blocks, compared)
    out = {(n, x) for n, a in gone for x in range(a, a + size[n, a])}
    left = [(n, i, x, words(line)) for n, (i, t) in enumerate(rows) for x, line in enumerate((t or "").split("\n")) if words(line) and (n, x) not in out]
    known = [m for m in left if m[1] is not None]
    gone_lines = later(known, [True] * len(known))
    result = []
    for n, (i, t) in enumerate(rows):
        mine = {**{k: v for k, v in gone.items() if k[0] == n}, **{k: v for k, v in gone_lines.items() if k[0] == n}}
        drop = {x for m, x in out if m == n} | {x for m, x in gone_lines if m == n}
        count = sum(m == n and (size[m, a] > 1 or (m, a) in gone) for m, a in size) + sum(m[0] == n for m in left)
        removed = sum(k[0] == n for k in gone) + sum(k[0] == n for k in gone_lines)
        result.append((i, count, removed, ",".join(map(str, sorted(set(mine.values())))), "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in drop)))
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_and_short_lines_match_brute_force(spark, same_rows, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    long = [prose(rng, rng.randrange(20, 60), words) for _ in range(4)]
    short = [prose(rng, rng.randrange(1, 5), words) + rng.choice(["", ".", ":"]) for _ in range(6)]
    lists = [[prose(rng, rng.randrange(2, 9), words) + "." for _ in range(6)] for _ in range(3)]

    def piece():
        kind = rng.randrange(5)
        if kind == 0:
            w = rng.choice(long).split(" ")
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = rng.choice(words)
            n = rng.randrange(5, 30)
            return "\n".join(" ".join(w[k : k + n]) for k in range(0, len(w), n))
        if kind == 1:
            return rng.choice(short)
        if kind == 2:
            lines = list(rng.choice(lists))
            if rng.random() < 0.6:
                lines[rng.randrange(6)] = prose(rng, rng.randrange(2, 9), words) + "."
            return "\n".join(lines)
        return prose(rng, rng.randrange(1, 25), words) if kind == 3 else rng.choice(long)

    rows = [(k, "".join(piece() + rng.choice(["\n", "\n\n", "\n \n"]) for _ in range(rng.randrange(1, 6)))) for k in range(45)]
    rows += [(100, None), (101, ""), (None, long[0]), (102, "\n\n"), (103, rows[3][1])]
    found = paragraphs.remove_repeated_paragraphs(as_docs(spark, rows), min_words=1)
    same_rows([(*r[:3], ",".join(map(str, r["sources"])), r["kept"]) for r in found.collect()], slow_registered(rows))


def test_empty_table_and_no_repeats(spark):
    docs = as_docs(spark, [(1, "a b c"), (2, None)])
    assert [r["n_removed"] for r in paragraphs.remove_repeated_paragraphs(docs).collect()] == [0, 0]
    assert paragraphs.remove_repeated_paragraphs(docs.limit(0)).collect() == []


def test_short_lines_and_wrapped_paragraphs(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    short, tiny = "share this page with all of your friends", "Read more"
    w = prose(rng, 60, words).split(" ")

    def wrapped(w, n):
        return "\n".join(" ".join(w[k : k + n]) for k in range(0, len(w), n))

    own = [prose(rng, 12, words) for _ in range(6)]
    rows = [
        (0, f"{own[0]}.\n{short}.\n{tiny}"), (1, f"{own[1]}.\n{short.upper()}.\n{tiny}"), (2, f"{own[2]}\n\n{wrapped(w, 11)}\n\n{own[3]}"),
        (3, f"{own[4]}\n\n{wrapped(w, 13)}"), (4, wrapped(w[:30] + ["new"] + w[31:], 10)), (5, f"{' '.join(w)}\n{own[5]}."),
    ]
    found = {r["doc_id"]: r for r in paragraphs.remove_repeated_paragraphs(as_docs(spark, rows), min_words=1).collect()}
    assert [found[k]["kept"] for k in (0, 2)] == [rows[0][1], rows[2][1]]
    assert found[1]["kept"] == own[1] + "." and (found[1]["n_removed"], found[1]["sources"]) == (2, [0])
    assert found[3]["kept"] == own[4] + "\n" and (found[3]["n_removed"], found[3]["sources"]) == (1, [2])
    assert found[4]["kept"] == "" and found[4]["sources"] == [2]
    assert all(r["n_paragraphs"] >= r["n_removed"] for r in found.values())
    found = {r["doc_id"]: r["kept"] for r in paragraphs.remove_repeated_paragraphs(as_docs(spark, rows)).collect()}
    assert found[1] == f"{own[1]}.\n{tiny}"


def test_lines_of_a_near_copied_list_are_kept(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    lines = [prose(rng, 15, words) + "." for _ in range(10)]
    new = prose(rng, 15, words) + "."
    rows = [(1, "\n".join(lines)), (2, "\n".join([*lines[:9], new]))]
    found = {r["doc_id"]: r["kept"] for r in paragraphs.remove_repeated_paragraphs(as_docs(spark, rows)).collect()}
    assert found == {1: rows[0][1], 2: new}
    short = [prose(rng, 3, words) + "." for _ in range(30)]
    rows = [(1, "\n".join(short)), (2, "\n".join([*short[:29], "quite another one."]))]
    found = {r["doc_id"]: r["kept"] for r in paragraphs.remove_repeated_paragraphs(as_docs(spark, rows)).collect()}
    assert found == {1: rows[0][1], 2: ""}  # lines too short to be compared: the block is
