"""Job settings: where data lives and how each shop's documents are shaped."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Shop labels, object prefixes and output names that stored data uses.
SHOP_L = "line_shopping"
SHOP_W = "watson"
ENVELOPE_L = "line_shopping"
ENVELOPE_W = "watsons"
PROTOTYPE_LABEL = {SHOP_L: "line", SHOP_W: "watson"}
MATCH_QUERY_NAME = "base_product_name (from line)"
MATCH_BASE_NAME = "base_product_name (from watson)"
MAP_QUERY_NAME = "query_product_name_from_line"
MAP_BASE_NAME = "base_product_name_from_watson"
MATCH_FAILED = "Matching Failed"
QUERY_VECTOR_ERROR = "N/A (Query Embedding Error)"
PAGE_SIZE = 200
TOP_N = 3
MIN_SIMILARITY = 0.8
STRICT_MIN_SIMILARITY = 0.82
RATIO_MIN = 1.5
RATIO_BAND = (0.5, 1.5)
EMBED_BATCH = 100
MIN_NORM = 1e-9


@dataclass(frozen=True)
class SourceSpec:
    """How to read one shop's documents.

    ``price_paths`` and ``name_paths`` are tried in order; the first truthy value
    wins and the last one is used when none is.
    """

    name: str
    envelope_name: str
    prefix: str
    list_path: tuple[str, ...]
    name_paths: tuple[str, ...]
    price_paths: tuple[str, ...]
    pages_path: str
    results_path: str
    first_page: int


SPEC_L = SourceSpec(
    name=SHOP_L,
    envelope_name=ENVELOPE_L,
    prefix="line_shopping",
    list_path=("data", "products", "products"),
    name_paths=("$.name", "$.product_name"),
    price_paths=("$.salePrice", "$.price"),
    pages_path="$.data.shops.totalPage",
    results_path="$.data.shops.totalShop",
    first_page=1,
)

SPEC_W = SourceSpec(
    name=SHOP_W,
    envelope_name=ENVELOPE_W,
    prefix="watson",
    list_path=("products",),
    name_paths=("$.name",),
    price_paths=("$.price.value",),
    pages_path="$.pagination.totalPages",
    results_path="$.pagination.totalResults",
    first_page=0,
)

SPECS = (SPEC_L, SPEC_W)


@dataclass(frozen=True)
class JobConfig:
    """Locations below one storage root; the history is kept in a file format of Spark's."""

    root: str
    table_format: str = "parquet"

    def landing_glob(self, day: dt.date, spec: SourceSpec) -> str:
        return f"{self.landing_root}/{day:%Y-%m-%d}/{spec.prefix}*"

    @property
    def landing_root(self) -> str:
        return f"{self.root}/pre_landing"

    @property
    def landed_root(self) -> str:
        return f"{self.root}/landed"

    @property
    def history(self) -> str:
        return f"{self.root}/product_history"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def set_aside(self) -> str:
        return f"{self.root}/set_aside"

    @property
    def staged(self) -> str:
        return f"{self.root}/cache/staged"

    @property
    def name_map(self) -> str:
        return f"{self.root}/base_product_name"

    @property
    def name_numbers(self) -> str:
        return f"{self.root}/cache/name_numbers"

    @property
    def snapshots(self) -> str:
        return f"{self.root}/cache/snapshots"

    @property
    def embedding_cache(self) -> str:
        return f"{self.root}/cache/embeddings"

    @property
    def match_result(self) -> str:
        return f"{self.root}/cache/match_result"

    def report(self, day: dt.date) -> str:
        return f"{self.root}/reports/{day:%Y-%m-%d}"

    def manifest(self, run_ts: dt.datetime) -> str:
        return f"{self.root}/metadata/product_comparison_{run_ts:%Y-%m-%d_%H-%M-%S}"
