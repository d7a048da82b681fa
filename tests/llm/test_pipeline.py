"""The whole pipeline against a plain version of every stage after the learned one."""

import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from shelflens.llm import toxicity
from shelflens.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """All documents of a driver table and some odd ones."""
    path = str(tmp_path_factory.mktemp("docs"))
    long = "one two three four five six seven eight nine ten eleven twelve " * 4000
    odd = [
        (10**9, None, "en", "web", 0), (10**9 + 1, "", "en", "web", 0), (10**9 + 2, long, "en", None, 0),
        (10**9 + 3, long + "end", "en", None, 0), (10**9 + 4, " \n ", "de", "only blank", 0),
        (10**9 + 5, "two words", None, "tiny", 0), (10**9 + 6, "two words", None, "tiny", 0),
        (None, "a text without an id <|endoftext|>", "en", "tiny", 0),
    ]
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    docs.union(spark.createDataFrame(odd, SCHEMA)).write.parquet(f"{path}/documents.parquet")
    table(spark, SF, "labels").write.parquet(f"{path}/labels.parquet")
    return path


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def low(doc_id):
    return (doc_id is None, doc_id or 0)


def one_of_each_group(docs):
    prints = [plain_fingerprint(d["text"]) for d in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, x in enumerate(prints):
        for b in range(a):
            if (x ^ prints[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for i, d in enumerate(docs):
        groups[find(i)].append(d)
    return [min(g, key=lambda d: low(d["doc_id"])) for g in groups.values()]


def mixed(docs):
    sizes = [len((d["text"] or "").encode().split()) for d in docs]
    sources = sorted({d["source"] for d in docs}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    total = {s: sum(n for d, n in zip(docs, sizes) if d["source"] == s) for s in sources}
    left, target, rest = Fraction(3, 2) * sum(total.values()), {}, set(sources)
    while rest:
        level = left / sum(weight[s] for s in rest)
        full = {s for s in rest if 2 * total[s] <= weight[s] * level}
        target |= {s: 2 * total[s] for s in full} if full else {s: weight[s] * level for s in rest}
        left -= sum(2 * total[s] for s in full)
        rest = rest - full if full else set()
    out = []
    for s in sources:
        own = [(hashlib.md5(str("" if d["doc_id"] is None else d["doc_id"]).encode()).hexdigest(), d, n)
               for d, n in zip(docs, sizes) if d["source"] == s]
        passes, room = divmod(int(target[s]), total[s]) if total[s] else (0, 0)
        for _, d, n in sorted(own, key=lambda x: x[0]):
            part = min(n, room)
            room -= part
            out += [d] * (passes + (2 * part >= n)) if n else []
    return out


def test_pipeline_equals_plain_version(spark, folder):
    docs = table(spark, folder, "documents")
    judged = toxicity.judge(docs, table(spark, folder, "labels"))
    clean = {r.doc_id for r in judged.filter("score < 0.3").collect()}
    texts = {}
    for d in (r.asDict() for r in docs.collect() if r.doc_id in clean):
        other = texts.get(d["text"] or "")
        if other is None or (d["doc_id"] is not None and (other["doc_id"] is None or d["doc_id"] > other["doc_id"])):
            texts[d["text"] or ""] = d
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    want, known = Counter(), {}
    for d in mixed(one_of_each_group(list(texts.values()))):
        if d["doc_id"] not in known:
            ids = tok.encode(d["text"], add_special_tokens=False).ids
            text = tok.decode(ids, skip_special_tokens=False)
            known[d["doc_id"]] = (d["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(text))
        want[known[d["doc_id"]]] += 1
    got = Counter(map(tuple, corpus_pipeline.run(spark, folder).collect()))
    assert 0 < len(texts) < docs.count() and got == want


def test_stages_keep_columns_and_take_empty_tables(spark, folder):
    docs = table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, docs.limit(0), folder)
        assert none.count() == 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert none.columns == docs.columns, name
