"""Codes, lists and lookup rows that results depend on. Plain data, no logic."""

# --- stores -------------------------------------------------------------------------------------
STORE_RANGE = ("00001", "00150")
WAREHOUSE_ORIGIN = "00944"
CLOSED_STORES = ("00027", "00028", "00042", "00060", "00063", "00079", "00089", "00092", "00093", "00101")
UNREPORTED_STORES = ("00020", "00027", "00028", "00042", "00060", "00063", "00079", "00089", "00092", "00093",
                     "00101", "00106")
STORE_REPORT_SKIPPED = ("00011", "00020", "00027", "00028", "00042", "00052", "00060", "00063", "00079", "00089",
                        "00092", "00093", "00101", "00106")
STORE_REPORT_BELOW = "00200"
LATE_REOPEN_STORES = ("00061", "00062", "00066", "00107")
LATE_REOPEN_WEEK = 21
REOPEN_WEEK_BY_DISTRICT = {
    "Arizona": 20, "Austin": 19, "California": 23, "Chicago": 23, "Columbus": 20, "Dallas South": 19,
    "Georgia": 20, "Houston North": 19, "Houston South": 19, "Indiana": 20, "Iowa/Nebraska": 20, "Kansas": 20,
    "Kentucky": 21, "Minnesota": 21, "North Texas": 19, "Oklahoma": 19, "Penn-Cleveland": 20, "San Antonio": 19,
    "Southern Ohio": 20, "St. Louis": 21, "Washington": 23, "Wisconsin": 21, "Dallas North": 19, "Tarrant": 19,
}

# --- item code lists ----------------------------------------------------------------------------
USED_ITEMS_OUTSIDE_BASE = (
    "00000000000010058656", "00000000000010058657", "00000000000010058658", "00000000000010017201",
    "00000000000010017202", "00000000000010041275", "00000000000010017203", "00000000000010017200",
)
SUPPLY_ITEMS = ("00000000000010051490", "00000000000010196953", "00000000000010200047")
MASTER_EXTRA_ITEMS = (
    "00000000000010041274", "00000000000010205940", "00000000000010205941", "00000000000010205942",
    "00000000000010205943", "00000000000010211475", "00000000000010211476", "00000000000010200074",
    "00000000000010200073", "00000000000010200072", "00000000000010200071", "00000000000010199947",
    "00000000000010199946", "00000000000010199945", "00000000000010199944", "00000000000010199943",
    "00000000000010199942", "00000000000010199941", "00000000000010199940", "00000000000010199939",
    "00000000000010199938", "00000000000010044333", "00000000000010044334",
)
NOT_BUY_ITEMS = (
    "00000000000000005766", "00000000000000005780", "00000000000000005782", "00000000000000005783",
    "00000000000000005781", "00000000000000005786", "00000000000000005785", "00000000000000005801",
)

# --- product types ------------------------------------------------------------------------------
NEW_GOODS_SKIPPED_TYPES = ("HPBP", "PRMO", "SUP", "HBF", "PBF", "TRF")
FRONTLINE_SKIPPED_TYPES = ("HPBP", "PRMO", "SUP")
MASTER_SKIPPED_TYPES = ("HPBP", "PRMO", "CHA", "PGC", "EGC")
FRONTLINE_TYPES = ("BDGF", "CALF", "HBF", "LPF", "NBAF", "NBJF", "PBF", "TOYF", "TRF", "VGF")
BESTSELLER_TYPES = ("HBF", "PBF", "TRF")
LOW_RATIO_TYPE = "NOST"

# --- vendors ------------------------------------------------------------------------------------
REORDER_DISTRIBUTORS = ("IDB&TDISTR", "IDINGRAMDI")
TOTE_VENDOR = "IDTXBKSTAP"
SPECULATIVE_VENDOR = "IDCDCSPECU"
SUPPLY_VENDOR = "WHPBSUPPLY"
TRO_VENDORS = ("TEXASBKMNA", "TEXASBKMNB", "TEXASBKNON", "TEXASSTATI", "TEXASBKPUZ", "TEXASBKUPC")
DEFAULT_TRO_VENDOR = "TEXASBKMNA"
EXTRA_TRO_VENDOR = "IDTEXASBOO"
TRO_MARK = "TTBReorder"
HRO_VENDORS = (
    "IDAURORA", "IDBENDONPU", "IDBKSALESI", "IDBOOKDEPO", "IDBRYBELLY", "IDCRAZART", "IDCROWNB&C", "IDCROWNPOI",
    "IDCUDDLEBA", "IDC&DVISIO", "IDEUROGRA", "IDFOUNDIMG", "IDIGLOOBOO", "IDKALANLPT", "IDKIKKERLA", "IDLBMAYASS",
    "IDMELISSA&", "IDMODERNPU", "IDNOSTIMAG", "IDOUTOFPRI", "IDPEEPERS", "IDSALESCOR", "IDTOYSMITH", "IDUNEMPLOY",
    "IDUSPLAYIN", "IDWISHPETS", "IFDISCONFO", "IFPROPERRE",
)
EXTRA_VENDOR_GROUPS = (("CDC", "CDC"), ("BS-i", "BS"), ("BS-r", "BS"), ("Inac", "HRO"))

# --- transfers ----------------------------------------------------------------------------------
TRANSFER_KINDS = {1: "tsh", 2: "dnt", 3: "sts", 4: "bsm", 5: "mkt", 6: "rtn", 7: "dmg"}
STORE_TO_STORE = 3
TRANSFER_CLOSED = 3
TRANSFER_LINE_OK = 1

# --- online -------------------------------------------------------------------------------------
MARKETPLACE_STATUSES = ("New", "Pending", "Shipped")
FULFIL_SYSTEM = "MON"
FULFIL_LINE_STATUSES = (1, 4)
USED_MARKET_SERVERS = ("4", "5", "11")

# --- warehouse ----------------------------------------------------------------------------------
WAREHOUSE_COMPANIES = ("TTB", "HPB")
STOCK_CLASS = "Inventory"
WHOLESALE_ORDER_TYPES = ("TTB WHOLESALE", "WEBORDER")
REORDER_ORDER_TYPES = ("TTB Reorders", "TTB Initial")
WHOLESALE_SKIPPED_CUSTOMERS = ("SAMPLE", "REPS")
PUSH_ORDER_TYPES = ("ASSORTMENT", "ASSORTMENTS", "HPB Assortment", "HPB Assortment by Ship", "HPB Titles",
                    "HPB Titles2", "TITLES")
SEASONAL_CATEGORIES = ("Blank", "Booklight", "Bookmark", "Eyeglasses", "Headphones", "Metalsigns", "Notecards",
                       "Puzzles")
PULL_ORDER_TYPES = ("TTB WHOLESALE", "WEBORDER", "TTB WHOLESALE BP", "WEBORDER BP", "TTB Reorders",
                    "TTB Reorders BP")
INITIAL_ORDER_TYPES = ("TTB Initial",)
STORE_PULL_ORDER_TYPES = ("HPB REORDERS",)
SUPPLY_ORDER_TYPES = ("SUPPLIES", "Store Order")
OUTSIDE_ORDER_TYPES = ("TTB WHOLESALE", "WEBORDER", "TTB WHOLESALE BP", "REPLENISHMENT", "WEBORDER BP",
                       "TTB Reorders")
DETAILED_GOAL_CAPS = ("A", "B", "SNL")
OUTBOUND_LEDGER_KINDS = ("CDC", "Drps")
SALE_LEDGER_KINDS = ("Sale", "iSale", "hSale", "Rtrn")
JUNK_PURCHASE_ORDERS = ("513161", "509383", "510155", "509725")
SKIPPED_SECTIONS = ("0", "BCD", "BTFic", "BTNonFic", "Kids", "NONE", "Stash", "")
MISSING_SECTION = "--SectionMissing--"
STATUS_PO_ONLY = "1a - PO without Rcts"
STATUS_PO_PARTIAL = "1b - PO with Rcts"
STATUS_OPEN_RECEIPT = "2 - Open Rct"
STATUS_STOCK = "3 - Scale Inv"
STATUS_WAVED = "4 - Waved Inv"
NO_RECEIPT = "no rct"
