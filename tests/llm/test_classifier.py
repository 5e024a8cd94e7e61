"""What the perplexity classifier rejects, by label and language."""

import collections
import os

from riskloom.llm import perplexity, store


def test_rejected_by_label_and_language(spark, sf):
    # The smallest table has too few labels in a language.
    sf = os.path.join(os.path.dirname(sf), "sf0.01")
    labels = {r["doc_id"]: "bad" if not r["quality"] else "toxic" if r["toxic"] else "clean" for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rejected, total = collections.Counter(), collections.Counter()
    trusted, threshold = collections.defaultdict(list), {}
    for r in perplexity.classify(store.documents(spark, sf), perplexity.trusted_ids(spark, sf)).collect():
        if label := labels.get(r["doc_id"]):
            total[label, r["lang"]] += 1
            rejected[label, r["lang"]] += not r["kept"]
            threshold[r["lang"]] = r["threshold"]
            if label == "clean":
                trusted[r["lang"]].append(r["log_perplexity"])
    for lang, found in trusted.items():
        assert rejected["bad", lang] >= 0.95 * total["bad", lang]
        assert rejected["clean", lang] <= 0.01 * total["clean", lang]
        mean = sum(found) / len(found)
        spread = (sum((x - mean) ** 2 for x in found) / len(found)) ** 0.5
        # Fewer than 200 in a language: the quantile is the largest.
        assert len(found) < 200 and abs(threshold[lang] - max(found) - spread) < 0.002
    toxic = [sum(n for (label, _), n in c.items() if label == "toxic") for c in (rejected, total)]
    assert 0.1 < toxic[0] / toxic[1] < 0.5
