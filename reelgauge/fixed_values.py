"""Lists, labels, limits and ranges that results depend on."""

# Channel ids of each niche, in catalogue order. Three channels
# of "Financas" and one of "Fitness" are also in "Podcast"; one id is listed
# twice.
NICHE_CHANNELS = {
    "Fitness": [
        "UCGfrC6R2PSMeXv4hdhONB6Q",
        "UCEI44xNfQmAukxMf1kW8d5g",
        "UCd4g7oX49jtbX7rN-wclkJg",
        "UCmK5h2-a4CquS4nIxDN6j7g",
        "UCU_q46MCMEu5l2QdshV0hGQ",
        "UCPlemwX82_QEWRDC6yYnOCg",
        "UC6gJAnIhDn2Fy_jZfICmgSA",
        "UCNEUXTXD8IhDqxR7sosYOow",
        "UCy-R3H4s0z1HubB_uSiGsHA",
        "UC0EPH87G38158HBGzDSSZ1Q",
        "UCjbknPNDsL9fd860cDInPGw",
        "UCBtOMJf4ZB6yXZQx98vIN7w",
        "UCOOLLUHhjJ-I6dXTQ-5cq5g",
        "UC7RaQvO8fqoyd62RmIg_yGA",
        "UCA0eYfmteLgN7bFZaMDXGUw",
        "UCdRhxTB5X5XoJvamINrrijQ",
        "UCTmAy9D7NR8sHdn3Oup1wlQ",
        "UCaZLOsun_sY6BonjwR8Zo4A",
        "UC5BW1WJ3ioahNzFUBdJ7cLQ",
        "UCfvg8A2uKlOmC1xWnUk7tpQ",
        "UCbgmJsnqdzu9aHTEvQGupfg",
        "UCUOsr03iLj627hJm55cmIPw",
        "UCLfCo17TCjx7qf-JMhQioLQ",
        "UCPX0gLduKAfgr-HJENa7CFw",
        "UC3dM3SoKkFJI5WOfY9yOlcw",
        "UCA_WXRDt9nz8exYNLto1gSA",
        "UCW8w8qOEKr_f1N6fEF13vxQ",
        "UCC4PiXBt_sGA7r3_eUPXAWg",
        "UC5UTV_AyFEzql9uZXMzCI5A",
        "UCWNp-LAUL3dQTOaADjTPAdg",
        "UC4sQ3Xv9UiSEhkgdTNGK_rA",
        "UC9cz05xObaFpB8U72t73IFA",
        "UC3wVslvR1r5lKPeh7wpoG8Q",
        "UCwf-NgPwT6kfljUyaujLAPw",
    ],
    "Financas": [
        "UCT4nDeU5pv1XIGySbSK-GgA",
        "UCCE-jo1GvBJqyj1b287h7jA",
        "UC8mDF5mWNGE-Kpfcvnn0bUg",
        "UCOjXqrOxAdXa04obIQREfCA",
        "UC6xhawZf2I30z9kAgqVEIvg",
        "UCM3vJxmuJJkk1r0yzFI9eZg",
        "UC8oofAsuieQv3imZGvaUDOQ",
        "UC-hA65Fjv5X8h-J92zc_L8Q",
        "UCIeL1JF5Q7ALE1qOGPJBm5w",
        "UCfMA8s_QXPPcuOTjTDFb4vA",
        "UC3Z2XdKUu21_KtMsohZedOQ",
        "UCPUb-aMI0HiBjC1rsuRN4ng",
        "UChBtPExX9RjCdmpAizK7ccQ",
        "UCNGqYuEd86K7dY70jE6dhKg",
        "UCA8l61FQjT1sGr28L-sbKqA",
        "UCwONybZQdULFV_ts2911Rqg",
        "UCrp0zmecZ3TNV8FSR-tjv7A",
        "UC_mSfchV-fgpPy-vuwML8_A",
        "UCfMA8s_QXPPcuOTjTDFb4vA",
        "UCzJPdSTGj7KPZLjaOatWS4A",
        "UCnBNoed6NaPlpL8blj1yy8Q",
        "UC6pkw1C4ha1cmU9aDJ8OxUw",
        "UCj3jEZuLmXOndQJFkPTp3Nw",
        "UCIjDZzIWu0wlkDbBImhCS7Q",
        "UCiHUp5cRkjcItPdldyJgd4Q",
        "UCU_UT4dJbSSPfTK52Yz9Agw",
        "UC7BsIosUdCz1utgm1Df1y_A",
        "UCteJrv6W7MWB5SoRvfjF36Q",
        "UCSXdP8V4jRaw-8YMTpa6glw",
        "UCLJkh3QjHsLtK0LZFd28oGg",
    ],
    "Podcast": [
        "UCj9R9rOhl81fhnKxBpwJ-yw",
        "UC4ncvgh5hFr5O83MH7-jRJg",
        "UCWZoPPW7u2I4gZfhJBZ6NqQ",
        "UCfMA8s_QXPPcuOTjTDFb4vA",
        "UCzJPdSTGj7KPZLjaOatWS4A",
        "UCuUUWPHIioyfmctnDpwsFzw",
        "UC9djCiv4e85Kd8G--GWlcoQ",
        "UCxcDCeShqZWIUQuEo2iJSVA",
        "UC9LH3xFOJCCp2VFRcZjNdRQ",
        "UCDE-BCkjudUvQEMrm0XsHUg",
        "UC5-aueB1RqpUc-EeAjtx9Lw",
        "UCTBhsXf_XRxk8w4rMj6WBOA",
        "UCSICdgxW9BIvsHqmSLNU8hQ",
        "UCPHvx0NxJubMU8QqZ6X_Efw",
        "UCUZfhX79dQrJvAgYefiXCCA",
        "UCnlR7Byv1irGXGokMXf9nAQ",
        "UCW8w8qOEKr_f1N6fEF13vxQ",
        "UC6xhawZf2I30z9kAgqVEIvg",
        "UC3BM4LVGTrG5OER815AM7Bg",
        "UC6iiSl-DJQF5t_YttyUZX6Q",
        "UCbroBIg8zvIH8-F4631wJhA",
        "UCvm40-L5lbzlxQSbVnfX8pQ",
        "UCeL1a4rpEA8UG9IQIewPccg",
    ],
    "Viagens": [
        "UCLPXpKv6WDc7mtapsbMyPHg",
        "UCOHptmhkQl0nPAPpghvJjRA",
        "UC5sMjGaQJXkQdZTzGkSjYDg",
        "UCWfRNn9fRe5gMc3QaE3AXkA",
        "UC-6_6nA-v9W057U5sX3tTXg",
        "UCOJNw9aHGRkYuIOqwU7yK-Q",
        "UCk6RUGsfWI-3kPrDlMUfvfQ",
        "UC6xoasG-FY3P1YHo8_gBG9g",
        "UCULwpDVKV_vOZQ4zRyoYgUA",
        "UCJy-lSzu5UzVvLn9nXvWovg",
        "UChT_BMoR8j1JakGNMCQOAkw",
        "UC2HcaGYdio1RRuu3lh9_mHA",
        "UC3W3fZG5oGQGGNoBYWwCrTg",
        "UCGQJv1EsV4kcVkZJ4FoeWdA",
        "UCbVz3Ux2FXbPgrDbOanPLlg",
        "UCNU8ZfLKcoJXRspbizt1Ycw",
        "UC3UnmT5IgPKdXkvPhdbulaQ",
        "UCV6Lb37EQLdaDu0VyI7yDPg",
        "UCngY-0fPeVYo-TdIBmj-hGg",
        "UCnqaJ5tlyhfQiaQR1id_DBA",
        "UCd76luTPgzdZ5FUDk74RK9w",
    ],
}

# Longest duration, in seconds, that still counts as short.
DEFAULT_CUT_SECONDS = 90
CUT_SECONDS = {"Podcast": 3600}

# Weekdays, Monday first, with their Portuguese labels.
WEEKDAYS_PT = {
    "Monday": "Segunda",
    "Tuesday": "Terça",
    "Wednesday": "Quarta",
    "Thursday": "Quinta",
    "Friday": "Sexta",
    "Saturday": "Sábado",
    "Sunday": "Domingo",
}

# Title length classes, right-closed, with their labels.
TITLE_LENGTH_BINS = [
    (0, 20, "< 20"),
    (20, 30, "20-30"),
    (30, 40, "30-40"),
    (40, 50, "40-50"),
    (50, 60, "50-60"),
    (60, 70, "60-70"),
    (70, 100, "> 70"),
]

# Portuguese stopwords.
STOPWORDS = [
    "a", "o", "e", "de", "da", "do", "em", "para", "com", "um", "uma", "os",
    "as", "que", "como", "-", "por", "seu", "sua", "seus", "suas", "na", "no",
    "nos", "nas", "ao", "aos", "à", "às", "pelo", "pela", "pelos", "pelas",
    "num", "numa", "nuns", "numas", "dum", "duma", "duns", "dumas",
]

# Code point ranges that count as emoji. The last one is wide and
# also covers CJK, Hangul and private use.
EMOJI_RANGES = [
    ("1F600", "1F64F"),
    ("1F300", "1F5FF"),
    ("1F680", "1F6FF"),
    ("1F700", "1F77F"),
    ("1F780", "1F7FF"),
    ("1F800", "1F8FF"),
    ("1F900", "1F9FF"),
    ("1FA00", "1FA6F"),
    ("1FA70", "1FAFF"),
    ("2702", "27B0"),
]
WIDE_EMOJI_RANGE = ("24C2", "1F251")

# Letters a keyword may hold, and its least length.
WORD_LETTERS = "a-zA-ZÀ-ÿ"
WORD_MIN_LENGTH = 3

# Labels of flags and of correlation classes.
EMOJI_LABELS = {True: "Com Emoji", False: "Sem Emoji"}
CORRELATION_LABELS = {"up": "positiva", "down": "negativa", "none": "pouca"}

# Limits and thresholds.
COMPARED_YEARS = [2023, 2024, 2025]
BATCH_SIZE = 50
TOP_WORDS = 100
POPULAR_QUANTILE = 0.75
TRIM_QUANTILE = 0.99
CORRELATION_LIMIT = 0.3
SIGNIFICANCE = 0.05
SHORTS_VIEW_RATIO = 1.5
SHORTS_ENGAGEMENT_RATIO = 1.2
