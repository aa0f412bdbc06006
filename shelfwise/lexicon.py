"""Word lists, key lists and patterns that decide results.

Everything here is data. The values are part of the meaning of the extracted
columns, so they are stated once and imported by the column functions.
"""

# The competitor dimension (id, name, country, base url).
COMPETITORS = [
    (1, "Bax-shop", "NL", "https://www.bax-shop.nl"),
    (2, "bol.com", "NL", "https://www.bol.com"),
    (3, "MaxiAxi", "NL", "https://www.maxiaxi.com"),
    (4, "Thomann", "DE", "https://www.thomann.nl"),
]
SHOP_ID = {"bax": 1, "bol": 2, "maxiaxi": 3, "thomann": 4}
SHOP_DOMAIN = {
    "bax": "bax-shop.nl",
    "bol": "bol.com",
    "maxiaxi": "maxiaxi.com",
    "thomann": "thomann.nl",
}

# Tracking parameters removed from urls, per shop.
UTM_KEYS = ["utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term"]
TRACKING_KEYS = {
    "bax": UTM_KEYS + ["ref"],
    "bol": UTM_KEYS + [
        "bltgh", "bltghc", "blt", "Referrer", "referrer", "promo", "promoCode",
        "gclid", "fbclid",
    ],
    "maxiaxi": UTM_KEYS + [
        "gclid", "gbraid", "wbraid", "fbclid", "_gl", "_ga", "_gid",
        "mc_cid", "mc_eid", "ref", "cid", "source",
    ],
    "thomann": [
        "ref", "referrer", "source", "spm", "gclid", "fbclid", "yclid",
        "mc_eid", "mc_cid", "cmp", "cmpid",
    ],
}
TRACKING_PREFIX = {"thomann": "utm_"}

# Words that mark a page path as being about microphones.
MICRO_KEYWORDS = ["micro", "microfoon", "mic", "microphone", "microphones"]

# Category slugs by priority; the first scores 100, each next 10 less.
PRIORITY_CATEGORIES = [
    "studiomicrofoons",
    "live-microfoons",
    "draadloze-microfoons",
    "usb-microfoons",
    "multimedia-av-microfoons",
    "microfoon-opnamesets",
    "zang-microfoon-startersets",
    "dynamische-microfoons",
    "condensatormicrofoons",
    "grootmembraan-condensatormicrofoons",
    "installatiemicrofoons",
]

# Path segments of accessory categories.
ACCESSORY_SEGMENTS = [
    "audiokabel-per-meter-rol",
    "beltpack-kabels-connectoren",
    "boompole-microfoonhengel",
    "microfoon-accu-s-laders",
    "microfoon-antennes-accessoires",
    "microfoon-beltpack-kabels-connectoren",
    "microfoon-boosters",
    "microfoon-capsules",
    "microfoon-clips",
    "microfoon-grills",
    "microfoon-klemmen-extensions",
    "microfoon-laders-dockingstations",
    "microfoon-opbergtassen-hoezen",
    "microfoon-overige-onderdelen",
    "microfoon-popfilters",
    "microfoon-riemen-houders",
    "microfoon-schroefdraadadapters",
    "microfoon-shockmounts",
    "microfoon-statief-accessoires",
    "microfoon-statief-tas",
    "microfoon-voorversterkers",
    "microfoons-zonder-capsule",
    "overige-stands",
    "social-distancing-hygiene-producten",
    "tablet-smartphone-houder",
    "vlog-microfoons-en-toebehoren",
    "windkappen",
    "microfoon-reflectiefilter",
]

# Path segments that never lead to a product.
NON_PRODUCT_SEGMENTS = [
    "aanbiedingen", "b-stock-aanbiedingen", "hot-new-releases", "top-10",
]

# JSON keys whose string value is a product link.
URL_JSON_KEYS = [
    "url", "producturl", "product_url", "productlink", "product_link",
    "canonicalurl", "canonical_url", "href", "link",
]

# Url parts that are never followed.
BLOCKED_URL_PARTS = ["/blog/", "/wishlist", "/checkout", "/basket", "/login", "/account"]
BLOCKED_URL_PARTS_THOMANN = [
    "/cart", "/checkout", "/login", "/account", "/wishlist", "/compare",
    "/compinfo", "compinfo_", "accessibility", "whistleblower",
]
INFO_PAGE_PARTS_THOMANN = [
    "/compinfo", "compinfo_", "accessibility", "whistleblower", "privacy",
    "impressum", "terms", "agb", "datenschutz", "kontakt", "about",
]
BLOCKED_URL_PARTS_MAXIAXI = [
    "/klantenservice", "/advies", "/blog", "/account", "/checkout", "/customer",
    "/cart", "/zoeken", "/search",
]

# Breadcrumb category slugs kept / dropped.
BOL_CATEGORY_ALLOWED = [
    "microfoons", "studiomicrofoon", "live-microfoon", "draadloze-microfoon",
    "usb-microfoon", "multimedia-av-microfoon", "zang-microfoon",
    "microfoon-opnameset",
]
BOL_CATEGORY_EXCLUDED = [
    "accessoire", "accessoires", "toebehoren", "onderdeel", "onderdelen",
    "statieven", "statief", "kabel", "kabels", "clip", "clips", "klem", "klemmen",
    "windkap", "windkappen", "popfilter", "popfilters", "capsule", "capsules",
    "shockmount", "shockmounts", "pistoolgreep", "pistoolgrepen", "opbergtassen",
    "hoezen", "flightcase", "flightcases", "accu", "lader", "laders", "booster",
    "boosters", "reflectiefilter", "reflectiefilters", "voorversterker",
    "voorversterkers", "vocal-effect", "vocal-effecten",
]

# Title words that make an item (not) a microphone, and known lines.
RELEVANT_WORDS = [
    "microfoon", "microfoons", "microphone", "mic", "lavalier", "dasspeld",
    "usb microfoon", "usb-microfoon", "studio microfoon", "studiomicrofoon",
    "draadloze microfoon", "draadloze-microfoon", "zangmicrofoon",
    "zang microfoon", "karaoke microfoon", "condensator microfoon",
    "dynamische microfoon", "shotgun microfoon", "richtmicrofoon",
]
IRRELEVANT_WORDS = [
    "koptelefoon", "koptelefoons", "headphone", "headset", "hoofdtelefoon",
    "oortjes", "earbuds", "speaker", "luidspreker", "partybox", "soundbar",
    "camera", "gimbal", "drone", "accessoire", "accessoires", "toebehoren",
    "kabel", "adapter", "statief", "statieven", "houder", "mount", "shockmount",
    "popfilter", "windkap",
]
KNOWN_LINES = [
    "dji mic", "rode", "røde", "shure", "maono", "fifine", "saramonic", "boya",
    "audio-technica", "samson", "behringer", "sennheiser",
]
RELEVANT_URL_PARTS = ["microfoon", "microphone", "mic-"]

# Subcategory discovery.
SEED_SUBCATEGORIES = [
    "zangmicrofoons", "instrumentenmicrofoons", "grootmembraan microfoons",
    "kleinmembraan condensatormicrofoons", "ribbon zangmicrofoons",
    "draadloosmicrofoons", "headset-microfoons", "lavalier-microfoons",
    "stereo-microfoons", "zendermicrofoons", "video- en cameramicrofoons",
    "reporter microfoons", "usb/podcast microfoons", "grensvlakmicrofoons",
    "microfoons voor installatie", "meetmicrofoons", "broadcast koptelefoons",
    "microfoonsets", "speciaal microfoon", "ovid serie",
]
SUBCATEGORY_EXCLUDED = [
    "accessoire", "accessoires", "microfoonstandaard", "microfoonstandaards",
    "statief", "statieven", "tafelstatief", "tafelstatieven", "houder", "houders",
    "beugel", "beugels", "zwanenhals", "zwanenhalzen", "microfoonhengel",
    "microfoonhengels", "kabel", "kabels", "aansluitkabel", "aansluitkabels",
    "shockmount", "shockmounts", "windbescherming", "popfilter", "popfilters",
    "phantom", "voeding", "adapter", "adapters", "koffer", "koffers", "tas",
    "tassen", "vervangingsonderdelen", "onderdelen",
]
SUBCATEGORY_BLOCKED_PATHS = [
    "video-podcast", "blowouts", "aktionen", "actie", "acties", "b_stock",
    "b-stock", "sale", "deals", "outlet", "topseller", "prodnews", "bf_",
    "blackfriday", "alle-producten-in-de-categorie", "brand", "merken",
]
SUBCATEGORY_KEYWORDS = [
    "microfoon", "microfoons", "mikro", "micro", "zangmicro", "instrumentenmicro",
    "condensator", "grootmembraan", "kleinmembraan", "ribbon", "headset",
    "lavalier", "usb", "podcast", "broadcast", "zender", "video", "camera",
    "reporter", "grensvlak", "installatie", "meetmicro", "ovid",
]

# Model texts that are not a model.
BAD_MODELS = {
    "bax": ["ditiontype", "editiontype", "conditiontype"],
    "bol": ["nvt", "n/a", "unknown", "onbekend", "nee", "ning", "eau", "ijk"],
}

# Stock phrases.
STOCK_POSITIVE = {
    "bol": ["in stock", "op voorraad", "direct leverbaar", "vandaag besteld", "morgen in huis"],
    "bax": ["op voorraad", "voor 23:59", "leverbaar", "morgen"],
    "thomann": ["direct leverbaar", "op voorraad", "in voorraad"],
}
STOCK_NEGATIVE = {
    "bol": [
        "uitverkocht", "tijdelijk uitverkocht", "niet leverbaar", "niet beschikbaar",
        "out of stock", "niet op voorraad",
    ],
    "bax": ["niet leverbaar", "uitverkocht", "tijdelijk niet beschikbaar", "niet op voorraad"],
    "thomann": ["niet leverbaar", "niet op voorraad", "uitverkocht"],
}

# Service phrases.
FREE_SHIPPING_WORDS = ["gratis verzending", "gratis bezorging", "gratis geleverd"]
PAID_SHIPPING_WORDS = ["verzendkosten", "bezorgkosten"]
PICKUP_WORDS = ["afhaalpunt", "ophaalpunt", "afhalen", "pickup point", "pick-up point"]
DELIVERY_WORDS = {
    "bax": ["bezorgen", "bezorgd", "geleverd", "levertijd", "thuisbezorgd", "morgen in huis"],
    "bol": ["bezorgen", "bezorgd", "geleverd", "levertijd", "thuisbezorgd", "morgen in huis"],
    "thomann": ["levering binnen", "levertijd", "werkdagen", "direct leverbaar"],
}
COURIER_WORDS = {
    "bax": ["postnl", "dhl", "dpd", "ups", "gls", "bezorger", "koerier"],
    "bol": ["postnl", "dhl", "dpd", "ups", "gls", "bezorger", "koerier"],
    "thomann": ["dhl", "ups", "ups express", "dpd", "gls", "fedex"],
}
FREE_RETURN_WORDS = [
    "gratis retourneren", "gratis retour", "kosteloos retourneren", "gratis terugsturen",
]
CHAT_WORDS = {
    "bol": ["chat", "livechat", "chatten", "chat met"],
    "thomann": ["chat", "chat nu", "chatten", "chat met"],
}
EMAIL_WORDS = [
    "stuur een bericht", "stuur ons een bericht", "contactformulier", "e-mail",
    "email", "mail ons",
]
PHONE_WORDS = ["bel ons", "telefonisch", "telefoon"]
SHOP_SUPPORT_WORDS = ["klantenservice", "hulp", "contact"]
SHOP_CONTACT_WORDS = ["klantenservice", "contact"]
WARRANTY_SHOP_WORDS = ["bax", "bax music", "bax-shop"]
WARRANTY_SHOP_NAME = {"bax": "Bax Music", "bol": "bol.com", "thomann": "Thomann"}

# Support link path parts and default support pages.
SUPPORT_LINK_PATTERN = {
    "bax": r"/klantenservice|/service|/contact",
    "bol": r"/klantenservice.*(?:/retour|/garantie|/bezorgen|/contact|/verzenden)",
    "thomann": r"helpdesk|compinfo_contact",
}
SUPPORT_LINK_DEFAULT = {
    "bax": None,
    "bol": "https://www.bol.com/nl/nl/klantenservice/",
    "thomann": "https://www.thomann.nl/compinfo_contact.html",
}
DEFAULT_COOLING_OFF_DAYS = {"bol": 30}

# Texts that mark a blocked, empty or consent page.
BLOCK_NEEDLES = [
    "access denied", "captcha", "cloudflare", "datadome", "unusual traffic",
    "verify you are human", "attention required", "request blocked",
]
SHELL_MARKERS = [
    "this is a modal window", "beginning of dialog window", "cookie", "toestemming",
    "consent", "accepteer", "accept all", "captcha", "access denied", "forbidden",
    "robot",
]
BLOCK_TITLE_NEEDLES = [
    "toestemming", "consent", "cookie", "verify", "verific", "access denied",
    "blocked", "captcha", "robot", "attention required",
]
BLOCK_BODY_NEEDLES = ["cookie", "toestemming", "consent", "captcha", "access denied"]
BLOCK_STATUS = [403, 429, 503]
CONSENT_PHRASES = [
    "met onze cookies", "cookies", "cookiebeleid", "cookie policy",
    "cookie-instellingen", "cookie instellingen", "gebruik van cookies",
    "privacy-instellingen", "privacy instellingen", "toestemming", "consent",
    "akkoord", "accept all", "alles accepteren",
]

# Patterns.
EURO_AMOUNT = r"€\s*\d[\d\.\s]*[,\.\d]{0,3}\d"
PLAIN_AMOUNT = r"\b\d[\d\.\s]*[,\.\d]{0,3}\d\b"
PHONE_PATTERN = {
    "bol": r"\b(\+31|0)\s?\d{1,3}[\s\-]?\d{3,4}[\s\-]?\d{3,4}\b",
    "thomann": r"\+\d{1,3}[\s\-]?\d{1,4}[\s\-]?\d{2,4}[\s\-]?\d{2,6}",
}
SHOP_MAIL_PATTERN = r"(?i)\b[a-z0-9._%+\-]+@thomann\.[a-z]{2,}\b"
