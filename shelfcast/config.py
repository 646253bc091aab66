"""Settings that tell the pipeline variants apart."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

MONTH, SHOP, ITEM = "month_id", "shop_id", "item_id"
KEYS = (MONTH, SHOP, ITEM)

# Duplicate shop ids and the id each one is folded into.
SHOP_REMAP = {0: 57, 1: 58, 11: 10, 40: 39}
# Shops and categories the long-lag variant leaves out, and one shop-month.
DROP_SHOPS = (9, 20, 33)
DROP_CATEGORIES = (8, 80, 81, 82)
DROP_SHOP_MONTH = (34, 18)
# Days per month, February always 28.
DAYS_IN_MONTH = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
# Platform names searched in a category name, in output order.
CONSOLES = ("PS2", "PS3", "PS4", "PSP", "PSVita", "XBOX 360", "XBOX ONE", "PC", "MAC", "Android")
# Codes of the category groups.
SUPERCATEGORY_CODES = {
    "Игровые консоли": 0,
    "Игры": 1,
    "Аксессуары": 2,
    "Доставка товара": 3,
    "Прием денежных средств для 1С-Онлайн": 4,
    "Карты оплаты": 5,
    "Кино": 6,
    "Книги": 7,
    "Музыка": 8,
    "Подарки": 9,
    "Программы": 10,
    "Misc": 11,
}
# Category names to overwrite, by category id.
CATEGORY_NAME_PATCHES = {
    0: "Аксессуары - PC (Гарнитуры/Наушники)",
    8: "Билеты - Билеты (Цифра)",
    9: "Доставка товара - Доставка товара",
    26: "Игры - Android (Цифра)",
    27: "Игры - MAC (Цифра)",
    28: "Игры - PC (Дополнительные издания)",
    29: "Игры - PC (Коллекционные издания)",
    30: "Игры - PC (Стандартные издания)",
    31: "Игры - PC (Цифра)",
    32: "Карты оплаты - Кино, Музыка, Игры",
    79: "Прием денежных средств для 1С-Онлайн - Прием денежных средств для 1С-Онлайн",
    80: "Билеты - Билеты",
    81: "Misc - Чистые носители (шпиль)",
    82: "Misc - Чистые носители (штучные)",
    83: "Misc - Элементы питания",
}
# Shop name and city spellings to repair.
SHOP_NAME_PATCHES = {'Сергиев Посад ТЦ "7Я"': 'СергиевПосад ТЦ "7Я"'}
CITY_PATCHES = {"!Якутск": "Якутск"}
DIGITAL_MARKER = "(Цифра)"
# Regularisation strengths tried by the ridge tuner.
LAMBDAS = (0.0, 1e-4, 1e-3, 1e-2, 1e-1, 1.0, 10.0, 100.0)


@dataclass(frozen=True)
class Encoding:
    """Mean target per (month, *keys), used through calendar lags."""

    name: str
    keys: tuple[str, ...]
    lags: tuple[int, ...] = (1,)


@dataclass(frozen=True)
class Variant:
    """One feature recipe. ``clip_at`` is 'monthly', 'panel' (both before encoding) or 'end'."""

    name: str
    target_month: int = 34
    max_quantity: float | None = 1000
    max_price: float | None = 100000
    drop_negative_price: bool = True
    returns: str = "zero"
    shop_remap: dict[int, int] = field(default_factory=lambda: dict(SHOP_REMAP))
    drop_shops: tuple[int, ...] = ()
    drop_categories: tuple[int, ...] = ()
    drop_shop_month: tuple[int, int] | None = None
    drop_cheapest_row: bool = False
    clip_at: str = "end"
    clip_range: tuple[float, float] = (0, 20)
    target_lags: tuple[int, ...] = (1, 2, 3)
    encodings: tuple[Encoding, ...] = ()
    price_lags: tuple[int, ...] = (1, 2, 3)
    price_trend: bool = True
    revenue_trend: bool = True
    fill_patterns: tuple[str, ...] = ("item_quantity", "revenue")
    burn_in: int = 2
    seniority: bool = False
    days_name: str = "days"

    def but(self, **changes) -> "Variant":
        return replace(self, **changes)


_SHORT = (
    Encoding("monthly_avg_item_quantity", ()),
    Encoding("item_monthly_avg_item_quantity", (ITEM,), (1, 2, 3)),
    Encoding("shop_monthly_avg_item_quantity", (SHOP,), (1, 2, 3)),
    Encoding("shop_item_monthly_avg_item_quantity", (SHOP, ITEM), (1, 2, 3)),
    Encoding("shop_subtype_monthly_avg_item_quantity", (SHOP, "category_subtype_code")),
    Encoding("city_monthly_avg_item_quantity", ("city_code",)),
    Encoding("item_city_monthly_avg_item_quantity", (ITEM, "city_code")),
)
_LONG_LAGS = (1, 2, 3, 6, 12)
_LONG = (
    Encoding("date_avg_item_cnt", ()),
    Encoding("date_item_avg_item_cnt", (ITEM,), _LONG_LAGS),
    Encoding("date_shop_avg_item_cnt", (SHOP,), _LONG_LAGS),
    Encoding("date_category_avg_item_cnt", ("item_category_id",)),
    Encoding("date_shop_category_avg_item_cnt", (SHOP, "item_category_id")),
    Encoding("date_city_avg_item_cnt", ("city_id",)),
    Encoding("date_item_city_avg_item_cnt", (ITEM, "city_id")),
)
# Encodings the long-lag recipe can also compute; its model does not read them.
LONG_EXTRA = (
    Encoding("date_shop_console_avg_item_cnt", (SHOP, "item_category_console_id")),
    Encoding("date_shop_super_avg_item_cnt", (SHOP, "item_supercategory_id")),
    Encoding("date_console_avg_item_cnt", ("item_category_console_id",)),
    Encoding("date_super_avg_item_cnt", ("item_supercategory_id",)),
)

LONG_LAG = Variant(
    name="long_lag",
    max_quantity=None,
    max_price=None,
    drop_negative_price=False,
    returns="drop",
    drop_shops=DROP_SHOPS,
    drop_categories=DROP_CATEGORIES,
    drop_shop_month=DROP_SHOP_MONTH,
    drop_cheapest_row=True,
    clip_at="monthly",
    target_lags=_LONG_LAGS,
    encodings=_LONG,
    price_lags=(1, 2, 3, 4, 5, 6),
    price_trend=False,
    revenue_trend=False,
    fill_patterns=("item_cnt", "item_quantity"),
    burn_in=11,
    days_name="num_days",
)
EARLY_CLIP = Variant(name="early_clip", clip_at="panel", encodings=_SHORT, burn_in=3)
LATE_CLIP = Variant(name="late_clip", encodings=_SHORT)
SEGMENTED = Variant(name="segmented", encodings=_SHORT, seniority=True)
