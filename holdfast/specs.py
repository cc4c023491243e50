"""Declarative parameters of the operators; defaults are the production settings."""

from __future__ import annotations

from dataclasses import dataclass, field

# Sector codes, by priority.
SECTOR_CODES = ("S11001", "S11002", "S121", "S122", "S123", "S124", "S125", "S126", "S127", "S128", "S129", "S1311", "S1313", "S14", "S15", "S2")
# Country ids, flagged words in names, replacements in names.
COUNTRY_IDS = ("1", "249", "250", "251", "252")
NAME_KEYWORDS = ("ltd", "limited", "plc", "management", "mr", "mrs", "capital", "llp", "investments", "group", "benefit", "holdings", "sir", "asset", "lord", "partners", "fund", "company", "trustees", "services")
NAME_REPLACEMENTS = {"ltd": "limited"}


@dataclass(frozen=True)
class ExtractSpec:
    """One input file and its clean-up, applied in the order of the fields."""

    path: str = ""
    format: str = "parquet"
    cast: dict[str, str] = field(default_factory=dict)
    isin: dict[str, list] = field(default_factory=dict)
    select: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    rename: dict[str, str] = field(default_factory=dict)
    distinct: bool = True
    schema: str | None = None


@dataclass(frozen=True)
class JoinSpec:
    """A frame to left-join, by name, and the columns to join on."""

    name: str
    keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class TextSpec:
    """A name normalisation: the steps run in the order of the fields."""

    lower_case: bool = True
    remove_punc: bool = True
    remove_nums: bool = True
    replace: dict[str, str] = field(default_factory=dict)
    tokenize: bool = True
    min_token_length: int = 1
    remove_stopwords: bool = True
    extra_stopwords: tuple[str, ...] = ()
    sort_tokens: bool = True
    unicode: bool = False


EXACT = TextSpec(remove_punc=False, replace=NAME_REPLACEMENTS, remove_stopwords=False)
LOOSE = TextSpec(remove_punc=False, replace=NAME_REPLACEMENTS, min_token_length=5)
RECOMMEND = TextSpec(replace=NAME_REPLACEMENTS, min_token_length=3)


@dataclass(frozen=True)
class LinkPass:
    """One pass of name matching: normalise, keep unique names of enough tokens, match."""

    text: TextSpec
    min_tokens: int = 0


PASSES = (LinkPass(EXACT), LinkPass(LOOSE, 3))


@dataclass(frozen=True)
class RegisterSpec:
    min_death_date: str = "2016-01-01"
    codes: tuple[str, ...] = SECTOR_CODES


# The columns of the holdings table, here and in FeatureSpec.
@dataclass(frozen=True)
class HoldingsSpec:
    start_date: str = "2016-01-01"
    end_date: str = "2017-12-31"
    countries: tuple[str, ...] = COUNTRY_IDS
    individuals: bool = False
    owner_cols: tuple[str, ...] = ("Owner_ID", "Owner_Name", "URL", "Owner_Type")
    required_cols: tuple[str, ...] | None = None


@dataclass(frozen=True)
class FeatureSpec:
    id_col: str = "Owner_ID"
    target: str = "esa"
    static_categorical: tuple[str, ...] = ("Style_Description", "Owner_Country_ID", "Turnover_Rating", "Orientation", "Active_Status", "Owner_Type")
    static_numerical: tuple[str, ...] = ("Total_Equity_Assets", "Securities_Held", "Securities_Bought", "Securities_Sold", "Turnover_Value")
    static_text: tuple[str, ...] = ("Owner_Name",)
    dynamic_categorical: tuple[str, ...] = ("Currency_Code", "Industry_Description", "Sector_Description", "LET_Desc", "Security_Class")
    dynamic_numerical: tuple[str, ...] = ("Shares_Changed", "Shares_Held", "Value_Held", "Value_Of_Shares_Changed", "Mkt_Cap_USD", "Shares_Outstanding")
    dynamic_date: tuple[str, ...] = ("Report_Date",)
    keywords: tuple[str, ...] = NAME_KEYWORDS
    fold_share: float = 0.05
    fold_labels_below: float = 50
    lower_keywords: bool = False


@dataclass(frozen=True)
class ModelSpec:
    id_col: str = "Owner_ID"
    target: str = "esa"
    test_share: float = 0.0
    weighted: bool = False
    min_max_prob: float = 0.6
    folds: int = 3
    seed: int = 0
    depths: tuple[int, ...] = (3, 5, 8)
    min_instances: tuple[int, ...] = (10, 20, 40)
    trees: tuple[int, ...] = (10, 20, 30)
    parallelism: int = 4
    balanced: bool = False
    stratified_folds: bool = False
    small_bytes: float = 1e9


# The other grid, of 48 settings, over stratified folds and with balanced classes.
BALANCED_MODEL = ModelSpec(weighted=True, balanced=True, stratified_folds=True, seed=123, depths=(5, 10, 15, 20), min_instances=(2, 5, 10, 15), trees=(30, 40, 50))
