"""Word lists, thresholds and patterns that results depend on."""

# Fixed values. They have to be these for results to agree with the rules being matched.

# Value tiers: name and lowest number of points, highest first; below all of them the default.
TIERS_WAREHOUSE = (("Platinum", 10000), ("Gold", 5000), ("Silver", 1000))
TIERS_REPORT = (("Platinum", 8000), ("Gold", 5000), ("Silver", 2000))
TIER_DEFAULT = "Bronze"

# Age bands: name and the age below which it applies, lowest first; above all of them the default.
BANDS_WAREHOUSE = (("18-24", 25), ("25-34", 35), ("35-44", 45))
BANDS_WAREHOUSE_DEFAULT = "45+"
BANDS_REPORT = (("18-24", 25), ("25-34", 35), ("35-49", 50))
BANDS_REPORT_DEFAULT = "50+"

# Departments by words in the position, first match wins.
DEPARTMENTS = (("%Manager%", "Management"), ("%Dealer%", "Gaming"), ("%Security%", "Security"))
DEPARTMENT_DEFAULT = "Operations"

# Device classes by words in the device text, any case, first match wins.
DEVICE_CLASSES = (("%Mobile%", "Mobile"), ("%Tablet%", "Tablet"))
DEVICE_DEFAULT = "Desktop"

# Game types: accepted spellings, lower case, and the stored word.
GAME_TYPES = {
    "slot": "Slot",
    "slots": "Slot",
    "poker": "Poker",
    "roulette": "Roulette",
    "blackjack": "Blackjack",
    "bingo": "Bingo",
}

# Allowed values.
TABLE_STATUSES = ("Available", "In Use", "Maintenance")
TABLE_STATUS_DEFAULT = "Available"
MACHINE_STATUSES = ("Online", "Offline", "Maintenance")
MACHINE_ACTIVE = "Online"
TRANSACTION_TYPES = ("Bet", "Win", "Deposit", "Withdraw")

# Text formats.
PATTERNS = {
    "date": r"^\d{4}-\d{2}-\d{2}\z",
    "timestamp": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z",
    "int": r"^\d+\z",
    "decimal": r"^\d+(\.\d+)?\z",
    "cents": r"^\d+(\.\d{1,2})?\z",
    "uuid": r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}\z",
}

# Report defaults.
SINCE = "2023-01-01"
TOP_LOYAL = 20
TOP_BETTORS = 10
RETENTION_DAYS = 30
DEVICE_TEXT_LIMIT = 100
