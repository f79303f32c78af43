"""Schemas of the raw records.  Field names and aliases are fixed by the producers."""

from __future__ import annotations

CARD_FACE = "struct<name string, printed_name string, mana_cost string, type_line string, oracle_text string, power string, toughness string, loyalty string, defense string, colors array<string>, image_uris struct<small: string, normal: string, large: string>>"

#: One printing of the bulk dump.
CARD = (
    "id string, oracle_id string, name string, printed_name string, lang string, mana_cost string, cmc double, "
    "type_line string, oracle_text string, power string, toughness string, loyalty string, defense string, "
    "colors array<string>, color_identity array<string>, keywords array<string>, legalities map<string,string>, "
    f"edhrec_rank int, card_faces array<{CARD_FACE}>, image_uris struct<small: string, normal: string, large: string>, "
    "set string, collector_number string, rarity string, released_at string, artist string, border_color string, "
    "frame string, full_art boolean, promo boolean, reprint boolean, digital boolean, scryfall_uri string, "
    "cardmarket_id bigint, prices struct<eur: string, eur_foil: string, usd: string, usd_foil: string, tix: string>"
)

SET = "code string, name string, set_type string, released_at string, block string, parent_set_code string, card_count int, icon_svg_uri string"
SET_PAGE = f"data array<struct<{SET}>>"
NAME_PAGE = "data array<struct<name: string>>, has_more boolean, next_page string"
#: Saved beside each response: the printing that was asked for.
TAG_RESPONSE = "set_code string, collector_number string, data struct<card: struct<name: string, taggings: array<struct<tag: struct<name: string, type: string>>>>>"
DECK = "deck_id string, commander string, card_name string"

#: Keys under which wrapped documents hold their list, tried in this order.
PRODUCT_LISTS = ("product", "products", "data", "singles")
PRICE_LISTS = ("priceGuides", "priceGuide", "price_guide", "product", "products", "data")

PRODUCT_ID = ("idProduct", "id_product", "IdProduct")
PRODUCT_NUMBERS = {"id_metaproduct": ("idMetaproduct", "id_metaproduct"), "count_reprints": ("countReprints", "count_reprints")}
PRODUCT_NAME = ("enName", "en_name", "name")
PRODUCT_TEXTS = {
    "website": ("website",),
    "image": ("image",),
    "game_name": ("gameName", "game_name"),
    "category_name": ("categoryName", "category_name"),
    "number": ("number",),
    "rarity": ("rarity",),
    "expansion_name": ("expansionName", "expansion_name"),
}
LOCALIZATIONS = ("localization", "localizations")
LANGUAGE_ID = ("idLanguage", "id_language")
LANGUAGE_NAME = ("languageName", "language_name")
LOCAL_NAME = ("name", "productName", "product_name")

PRICES = {
    "avg_price": ("avg", "Avg", "avgPrice", "avg_price", "AVG"),
    "low_price": ("low", "Low", "lowPrice", "low_price", "LOW"),
    "trend_price": ("trend", "Trend", "trendPrice", "trend_price", "TREND"),
    "german_pro_low": ("germanProLow", "german_pro_low", "GermanProLow"),
    "suggested_price": ("suggestedPrice", "suggested_price", "SuggestedPrice", "sell", "Sell"),
    "foil_sell": ("avg-foil", "foilSell", "foil_sell", "FoilSell"),
    "foil_low": ("low-foil", "foilLow", "foil_low", "FoilLow", "Foil Low"),
    "foil_trend": ("trend-foil", "foilTrend", "foil_trend", "FoilTrend", "Foil Trend"),
    "low_price_ex_plus": ("lowEx", "lowPriceExPlus", "low_price_ex_plus", "Low Price Ex+", "lowExPlus"),
} | {f"avg{n}": (f"avg{n}", f"Avg{n}", f"AVG{n}") for n in (1, 7, 30)} | {f"foil_avg{n}": (f"avg{n}-foil", f"foilAvg{n}", f"foil_avg{n}", f"FoilAvg{n}") for n in (1, 7, 30)}
