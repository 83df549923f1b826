"""Language by compression: the dictionary under which a text becomes smallest names its language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablescout.llm.common import text_bytes

#: Matches from four bytes, searched lazily: syllables count, and it costs about 0.15 core seconds a megabyte.
CODING = {
    "window_log": 18, "hash_log": 15, "chain_log": 15, "search_log": 4, "min_match": 4, "target_length": 16,
    "strategy": zstandard.STRATEGY_LAZY, "write_content_size": False, "write_checksum": False, "write_dict_id": False,
}
#: A long text is coded in parts, so that the dictionaries, not its own past, explain it to its end.
PART = 4096
#: The dictionaries hold, per language, pieces of PIECE bytes of at most SAMPLE documents, chosen by a hash.
SAMPLE, PIECE = 150, 400
#: Parts of a language that are sampled on their own before the language is.
PARTS = 64
MARGIN = 0.01
UNKNOWN = "und"


def fit_dictionaries(training: DataFrame, sample: int = SAMPLE, piece: int = PIECE) -> dict[str, bytes]:
    """Raw-content dictionaries by language, from rows (doc_id, text, lang); null langs and texts teach nothing.

    At most `sample` pieces a language come to the driver, all different: of equal texts, and of texts with equal
    pieces, one is used.  A piece is taken at a place drawn from the text's hash, so that texts with one opening differ.
    """
    rows = training.where("lang IS NOT NULL AND length(text) > 0").select(
        F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("mark"), "text",
    )
    places = F.greatest(F.length("text") - piece + 1, F.lit(1))
    start = (F.pmod(F.xxhash64("mark"), places) + 1).cast("int")
    rows = rows.select("lang", "mark", F.substring("text", start, F.lit(piece)).alias("piece"))
    rows = rows.groupBy("lang", "piece").agg(F.min("mark").alias("mark"))
    # in two steps: first of parts of a language, so that what one task gets of it does not grow with the tasks before
    for part in (F.pmod("mark", F.lit(PARTS)), F.lit(0)):
        first = Window.partitionBy("lang", part).orderBy("mark", "piece")
        rows = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample).drop("n")
    chosen = rows.select("lang", "mark", "piece")
    out: dict[str, list[str]] = {}
    for row in sorted(chosen.collect(), key=lambda r: (r.lang, r.mark, r.piece)):
        out.setdefault(row.lang, []).append(row.piece)
    return {lang: "\n".join(texts).lower().encode() for lang, texts in out.items()}


class Coder:
    """Sizes of texts under each language's dictionary, and under none."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self._coders = []
        for lang in self.langs:
            held = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coding = zstandard.ZstdCompressionParameters(**CODING)
            held.precompute_compress(compression_params=coding)
            self._coders.append(zstandard.ZstdCompressor(dict_data=held, compression_params=coding).compress)

    def sizes(self, text: bytes) -> np.ndarray:
        parts = [text[first : first + PART] for first in range(0, len(text), PART)]
        return np.array([sum(len(compress(part)) for part in parts) for compress in self._coders], float)


def _letters(text: str) -> bool:
    return any(map(str.isalpha, text))


def identify(documents: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """Per row of documents: doc_id, lang_pred, score (0 to 1), rejected.

    `und` with score 0 where the text is null or has no letter, or nothing was learned.  The smallest code
    wins, of equal ones the language first by name.  The score is the winner's share when each code counts
    2^-(bytes over the smallest).  A row is rejected if the runner-up is within `margin` of the smallest size:
    its lang_pred stays as the best guess.  Null and repeated doc_ids stay, a row for a row; there is no shuffle.
    """
    shared = documents.sparkSession.sparkContext.broadcast(dictionaries)  # SAMPLE * PIECE characters a language

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            langs, scores, rejected = [], [], []
            for raw in batch.column("text"):
                text = raw.as_py().decode("utf-8", "replace")
                if not coder.langs or not _letters(text):
                    langs.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                    continue
                sizes = coder.sizes(text.lower().encode())
                best = int(sizes.argmin())
                langs.append(coder.langs[best])
                scores.append(float(1 / np.exp2(-np.minimum(sizes - sizes[best], 60)).sum()))
                rest = np.delete(sizes, best)
                rejected.append(bool(len(rest) and rest.min() - sizes[best] <= margin * sizes[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs), pa.array(scores, pa.float64()), pa.array(rejected)],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    wanted = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(F.col("text")).alias("text"))
    return wanted.mapInArrow(identified, "doc_id long, lang_pred string, score double, rejected boolean")
