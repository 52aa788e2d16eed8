"""The operators' results in plain Python, for small tables."""

import hashlib
import random
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sample_texts(seed, n):
    """Texts that share lines, passages and whole contents, with a few odd ones."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["É", "ÀB", "X", "y,", "ß"]
    passage = " ".join(rng.choices(words, k=70))
    line = "A shared LINE of more than twenty characters "
    texts = [None, "", "  \t ", "\n\n", "one", "Two words", line, line.lower() + "\t"]
    while len(texts) < n:
        body = " ".join(rng.choices(words, k=rng.choice([3, 30, 60, 200])))
        kind = rng.randrange(6)
        if kind == 0:
            body = f"{body} {passage} {body}"
        elif kind == 1:
            cut = rng.randrange(20)
            body = f"{body} {' '.join(passage.split()[cut:])}"
        elif kind == 2:
            body = f"{line}\n{body}\n {line}"
        elif kind == 3 and texts[-1]:
            body = texts[-1]
        elif kind == 4 and texts[-1]:
            body = texts[-1].replace("w1", "w2", 1)
        texts.append(body)
    return texts


def line_dedup(rows, least_chars=20, least_docs=3):
    def key(line):
        return lower(line.strip(" \t\n\v\f\r"))

    where = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars and doc_id is not None:
                where.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            holders = where.get(key(line), ())
            if doc_id is None or len(holders) < least_docs or max(holders) == doc_id:
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def fingerprint(text, shingle=4):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    parts = [" ".join(words[n : n + shingle]) for n in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, linked):
    """The smallest reachable position for each of ``n``."""
    root = list(range(n))
    for _ in range(n):
        before = list(root)
        for a in range(n):
            for b in range(n):
                if linked(a, b):
                    root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    return root


def substring_dedup(rows, length=50):
    first = {}
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        for n in range(len(words) - length + 1):
            if doc_id is not None:
                w = tuple(words[n : n + length])
                first[w] = min(first.get(w, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for n in range(len(words) - length + 1):
            if doc_id is not None and first.get(tuple(words[n : n + length]), doc_id) < doc_id:
                gone[n : n + length] = [True] * length
        out.append((doc_id, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def shingles(text, n=5):
    """The set of the n-word shingles of a text; of fewer words the whole sequence."""
    words = WORD.findall(lower(text or ""))
    return {" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


MARKS = re.compile(r"(?: {0,3}>)+")


def passages(text):
    """The own text of a message, and (level, passage) of what it quotes."""
    lines, quoted, kept, before = re.split("\r\n|\r|\n", text or ""), [], [], 0
    for line in lines:
        mark = MARKS.match(line)
        level = mark.group().count(">") if mark else 0
        body = re.sub("^[ \t]", "", line[mark.end() :]) if mark else line
        if level and level == before:
            quoted[-1][1].append(body)
        elif level:
            quoted.append((level, [body]))
        before = level
        kept.append("" if mark else line)
    if not quoted:
        return text or "", []
    own = re.sub(r"\n[ \t]*\n(?:[ \t]*\n)*", "\n\n", "\n".join(kept))
    return own.strip(" \t\n"), [(level, "\n".join(body)) for level, body in quoted]


def parts(passage):
    """The normalised paragraphs, sentences and lines."""
    plain = lambda x: re.sub(r"[ \t\n\x0b\f\r]+", " ", x).strip(" ").lower()
    paragraphs = [plain(p) for p in re.split(r"\n[ \t]*\n", passage)]
    sentences = [x for p in paragraphs for x in re.split(r"(?<=[.!?]) |(?<=[。！？]) ?", p)]
    return {x for x in [*paragraphs, *sentences, *map(plain, passage.split("\n"))] if x}


def linked(rows):
    """``(conv_id, turn, parent, root, depth, quotations, own text)`` of ``(conv_id, turn, role, text)``."""
    first, parent, counts = {}, {}, {}
    known = [r for r in rows if r[0] is not None and r[1] is not None]
    for conv, turn, _, text in known:
        for part in parts(passages(text)[0]):
            first[conv, part] = min(turn, first.get((conv, part), turn))
    for conv, turn, text in {(r[0], r[1], r[3]) for r in known}:
        for level, passage in passages(text)[1]:
            for part in parts(passage):
                source = first.get((conv, part))
                if source is not None and source < turn:
                    best = (level, -len(part), source)
                    parent[conv, turn] = min(best, parent.get((conv, turn), best))
                    counts[conv, turn] = counts.get((conv, turn), 0) + 1
    out = []
    for conv, turn, _, text in rows:
        above, root, depth = parent.get((conv, turn)), turn, 0
        while (conv, root) in parent:
            root, depth = parent[conv, root][2], depth + 1
        out.append((conv, turn, above and above[2], root, depth, counts.get((conv, turn), 0), passages(text)[0]))
    return sorted(out, key=repr)
