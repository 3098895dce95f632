"""What each monthly feed produces: target schema, scoring keys, period columns.

One contract per feed. Target columns are named once, in one case (the
original type maps named columns the frames did not have); period columns
are the partition columns of the target dataset.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from ledgerloom.functions.scalars import normalize_header


@dataclass(frozen=True)
class FeedContract:
    name: str
    target_schema: str
    group_keys: tuple[str, ...]
    categories: tuple[str, ...]
    year_col: str = "year"
    month_col: str = "month"
    extra_scoring: tuple[tuple[str, ...], ...] = field(default=())


# fixed values: meter columns of the drop, and the kitchen groups they roll up into
METER_TEMPLATE = [
    "Дата", "Час", "Магазин", "Витяжка ПКВ", "Гриль шаурма", "Ел. плита",
    "Модульна піч", "ПКВ", "ПКВ гриль", "ПКВ допік", "ПКВ копчення", "ПКВ піч",
    "Піч піца", "Піч піца1", "Піч піца2", "Розстоєчна шафа", "Ротаційна піч", "Тензометрія ПКВ",
    "Тензометрія ПКВ гриль", "Тензометрія ПКВ допік", "Тензометрія ПКВ копчення",
    "Тензометрія Теплова вітрина",
    "Тензометрія Теплова вітрина1", "Тензометрія Теплова вітрина2", "Теплова вітрина",
    "Теплова вітрина1", "Теплова вітрина2", "ЩС Піца", "ЩС пекарня",
]
METER_GROUPS = {
    "Пиццерия": ["пічпіца", "пічпіца1", "пічпіца2", "тепловавітрина1", "щспіца"],
    "Допёк": ["ПКВ допік"],
    "Гриль": ["Витяжка ПКВ", "ПКВ", "ПКВ гриль", "ПКВ копчення", "ПКВ піч", "Теплова вітрина2"],
    "Стрит-Фуд": ["Гриль шаурма"],
    "Пекарня": ["ЩС пекарня"],
}
# fixed values: target column order of the meter table
METER_OUTPUT_GROUPS = ["Пиццерия", "Стрит-Фуд", "Пекарня", "Допёк", "Гриль"]
METER_DATE, METER_HOUR, METER_STORE = "дата", "час", "магазин"

# fixed values: headers of the tariff and labour sheets
TARIFF_TEMPLATE = ["МВЗ (Код)", "Место возникновения затрат", "kwt", "uah"]
LABOR_TEMPLATE = ["filid", "mm", "h", "region", "filialname"]
# fixed values: columns of the account report (row_no is added at landing)
ACCOUNTS_TEMPLATE = ["Стаття/МВЗ", "Назва", "uah", "percent"]
# fixed values: the shared role, its department code, and the departments it is split into
SHARED_ROLE = "Кулінарія/Гриль"
SHARED_DEPT = "104_105"
SHARED_SPLIT = [104, 105]


def normalized_groups(groups: dict[str, list[str]]) -> dict[str, list[str]]:
    return {g: [normalize_header(c) for c in cols] for g, cols in groups.items()}


CONTRACTS = {
    "meter": FeedContract(
        "meter",
        "year int, month int, filid int, `Пиццерия` double, `Стрит-Фуд` double, "
        "`Пекарня` double, `Допёк` double, `Гриль` double",
        ("filid",), tuple(METER_OUTPUT_GROUPS)),
    "labor": FeedContract(
        "labor",
        "y int, m int, filid int, depid int, hours double, cost_hour double, cost_labor double",
        ("filid", "depid"), ("hours", "cost_labor"), year_col="y", month_col="m"),
    "tariff": FeedContract(
        "tariff",
        "mvz string, year int, month int, consump_kwt double, consump_uah double, tariff double",
        ("mvz",), ("consump_kwt", "consump_uah", "tariff")),
    "accounts": FeedContract(
        "accounts",
        "filid int, account bigint, name string, year int, month int, sum double, share_TO double",
        ("filid", "account"), ("sum",), extra_scoring=(("filid",),)),
    "store_costs": FeedContract(
        "store_costs",
        "year int, month int, ym int, rcid int, filid int, lagerid int, proekt string, "
        "costs decimal(22,2)",
        ("rcid", "filid", "lagerid", "proekt"), ("costs",)),
    "dc_costs": FeedContract(
        "dc_costs",
        "year int, month int, ym int, rcid int, postid int, lagerid int, "
        "costsLogistics double, costsOther double, costs double",
        ("rcid", "postid", "lagerid"), ("costsLogistics", "costsOther", "costs")),
}
