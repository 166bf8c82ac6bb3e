"""Model configurations: the two category models and the values their operators need."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field
from typing import Mapping

IDENTITY = ("user_id", "account_id", "transaction_id", "date", "pending")
FEEDBACK_COLUMNS = IDENTITY + ("feedback_time", "category")
TARGET = "target_category"
TARGET_INDEX = "target_category_int"
MODEL_PREDICTION = "ModelPrediction"
MODEL_FALLBACK = "ModelFallback"
SAVINGS_ACCOUNT = "SAVINGS_ACCOUNT"
CURRENT_ACCOUNT = "CURRENT_ACCOUNT"

# Category names in index order, label maps, thresholds and replacement values.
RETAIL_TRAINABLE = (
    "Housing", "Personal care", "Groceries", "Eating out", "Shopping", "Travel", "Transport",
    "Bills", "Transfers", "Cash", "Leisure", "Internal", "Income", "Charity", "Coffee", "Drinks",
    "Education", "Expenses", "Investments", "Lunch", "Gifts", "Kids", "Takeaway", "Petrol", "Rent",
    "Mortgage", "Utilities", "Vehicle", "Pets", "Savings",
)
RETAIL_EXCLUDED = ("General",)

SME_OUTGOING_TRAINABLE = (
    "Interest and Repayments", "Investments", "Food and Drinks", "Vehicles and Driving Expenses",
    "Rent and Facilities", "Travel Expenses", "Marketing and Promotion", "Other Operating Costs",
    "Utilities", "Collection Costs", "Pension Payments", "Salaries", "Corporate Savings Deposits",
    "Equity Withdrawal", "Unspecified Tax",
)
SME_INCOMING_TRAINABLE = ("Tax Returns", "Equity Financing", "Loans", "Revenue")
SME_OUTGOING_EXCLUDED = ("Sales Tax", "Payroll Tax", "Corporate Income Tax", "Other Expenses")
SME_INCOMING_EXCLUDED = ("Other Income",)

PAY_LABELS = (
    ("[!RO]", "Internal"), ("[!TP]", "Internal"), ("[!DC]", "General"), ("[!DF]", "General"),
    ("[!DW]", "General"), ("[!DA]", "General"), ("[!DO]", "General"), ("[!DT]", "Internal"),
    ("[!XG]", "General"), ("[!RW]", "Income"), ("[!RF]", "Income"), ("[!EM]", "Internal"),
    ("[!ES]", "Savings"),
)

TAX_LABELS = {
    ("NL", "credit"): {
        "Dividendbelasting": "Tax Returns", "Loon_belasting": "Tax Returns",
        "Loonbelasting": "Tax Returns", "Loonbelasting_naheffing": "Tax Returns",
        "Motorrijtuigenbelasting": "Tax Returns", "Omzetbelasting": "Tax Returns",
        "Other": "Other Income", "Toeslag": "Other Income", "Venootschapsbelasting": "Tax Returns",
        "Voorlopige_belasting": "Tax Returns", "Zorgverzekeringswet": "Other Income",
        "Douanebelasting": "Tax Returns", "Overige": "Other Income",
        "Inkomstenbelasting": "Other Income", "Milieu_investeringsaftrek": "Other Income",
    },
    ("NL", "debit"): {
        "Acceptgiro": "Unspecified Tax", "Dividendbelasting": "Unspecified Tax",
        "Fijnstoftoeslag": "Unspecified Tax", "Inkomsten_belasting": "Unspecified Tax",
        "Inkomstenbelasting": "Unspecified Tax", "Douanebelasting": "Unspecified Tax",
        "Overige": "Unspecified Tax", "Inkomstenbelasting_gemoedbezwaarden": "Unspecified Tax",
        "Inkomstenbelasting_premievolksverzekering": "Unspecified Tax",
        "Loon_belasting": "Payroll Tax", "Loonbelasting": "Payroll Tax",
        "Loonbelasting_naheffing": "Payroll Tax", "Motorrijtuigenbelasting": "Unspecified Tax",
        "Motorrijtuigenbelasting_naheffing": "Unspecified Tax", "Omzetbelasting": "Sales Tax",
        "Omzetbelasting_naheffing": "Sales Tax", "Other": "Unspecified Tax",
        "Toeslag": "Unspecified Tax", "Venootschapsbelasting": "Corporate Income Tax",
        "Voorlopige_belasting": "Unspecified Tax", "Zorgverzekeringswet": "Unspecified Tax",
    },
    ("GB", "credit"): {
        "Child_benefit": "Other Income", "Child_tax_credit": "Unspecified Tax",
        "Working_tax_credit": "Other Income",
    },
    ("GB", "debit"): {
        "Self_assessment_tax": "Unspecified Tax", "Corporate_tax": "Corporate Income Tax",
        "VAT": "Sales Tax", "Vehicle_tax": "Unspecified Tax", "Council_tax": "Unspecified Tax",
    },
}

COUNTERPARTY_CATEGORIES = {
    "Shell": "Vehicles and Driving Expenses",
    "Tango": "Vehicles and Driving Expenses",
    "Lekker en GoedkoopTanken.nu": "Vehicles and Driving Expenses",
    "TheLoanSharks Loans": "Loans",
}

TEST_DESCRIPTION_PREFIX = "test_description:5cb92fb6-93c5-452f-aa27-53a485b8f370:"
INTEREST_PATTERN = "interest paid after tax .* deducted"
BUSINESS_USE_PATTERN = r"hmrc.*\bvat\b|\bxero\b|quickbooks|zoho.?books"
BUSINESS_USE_MIN_AMOUNT = 30

RETAIL_DEFAULTS = {
    "description": "", "transaction_type": "", "account_type": CURRENT_ACCOUNT, "amount": 0.0,
    "internal_transaction": "", "bank_specific__paylabels": "", "bank_specific__mcc": "",
    "counter_account_type": CURRENT_ACCOUNT, "bank_counterparty_name": "",
}
SME_DEFAULTS = {**RETAIL_DEFAULTS, "bank_counterparty_iban": ""}

NUMERIC_FEATURES = ("scaled_amount", "is_debit_transaction", "is_internal_transaction")
POSTPROCESSING_COLUMNS = (
    "internal_transaction", "bank_specific__paylabels", "bank_specific__mcc", "transaction_type",
    "account_type", "counter_account_type",
)
# End of fixed values.


@dataclass(frozen=True)
class ModelConfig:
    """One category model. Categories are indexed trainable first, excluded last.

    `clients` (client ids per domain) and `test_site_id` belong to a deployment: jobs need them, see
    `for_deployment`.
    """

    name: str
    trainable: tuple[str, ...]
    excluded: tuple[str, ...]
    countries: tuple[str, ...]
    domains: tuple[str, ...]
    threshold: float
    input_columns: tuple[str, ...]
    defaults: Mapping[str, object]
    clients: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    outgoing: tuple[str, ...] = ()
    incoming: tuple[str, ...] = ()
    join_counterparty: bool = False
    test_users_kept_country: str = "NL"
    test_site_id: str | None = None
    start_date: str = "2018-01-01"
    samples_per_country: int = 3_000_000
    production_samples: int = 100_000
    production_window_days: int = 30
    seed: int = 123
    validation_share: float = 0.1
    test_share: float = 0.1
    sequence_length: int = 60
    hash_buckets: int = 600_000
    #: "md5", which every engine can repeat, or "fingerprint", as models trained elsewhere number n-grams
    bucket_hash: str = "md5"
    embedding_size: int = 32
    margin: float = 0.1
    learning_rate: float = 0.01
    batch_size: int = 512
    max_epochs: int = 40
    max_retries: int = 2
    max_recall_rank: int = 3
    min_weighted: Mapping[str, float] = field(
        default_factory=lambda: {"precision": 0.60, "recall": 0.60, "f1_score": 0.60}
    )
    min_coverage: float = 0.80

    @property
    def categories(self) -> tuple[str, ...]:
        return self.trainable + self.excluded

    @property
    def max_tokens(self) -> int:
        # Unigrams and bigrams share the sequence, so tokens take half of it.
        return self.sequence_length // 2

    def index(self, category: str) -> int:
        return self.categories.index(category)

    def for_deployment(
        self, clients: Mapping[str, tuple[str, ...]], test_site_id: str
    ) -> "ModelConfig":
        missing = [d for d in self.domains if not clients.get(d)]
        if missing:
            raise ValueError(f"no clients for {', '.join(missing)}")
        return self.with_values(clients=clients, test_site_id=test_site_id)

    def with_values(self, **changes) -> "ModelConfig":
        return dataclasses.replace(self, **changes)


RETAIL = ModelConfig(
    name="retail",
    trainable=RETAIL_TRAINABLE,
    excluded=RETAIL_EXCLUDED,
    countries=("GB", "FR", "IT", "NL"),
    domains=("app",),
    threshold=0.45,
    input_columns=("description", "amount", "transaction_type", "internal_transaction"),
    defaults=RETAIL_DEFAULTS,
)

SME = ModelConfig(
    name="sme",
    trainable=SME_OUTGOING_TRAINABLE + SME_INCOMING_TRAINABLE,
    excluded=SME_OUTGOING_EXCLUDED + SME_INCOMING_EXCLUDED,
    countries=("GB", "NL"),
    domains=("business", "app"),
    threshold=0.65,
    input_columns=(
        "description", "bank_counterparty_name", "amount", "transaction_type",
        "internal_transaction",
    ),
    defaults=SME_DEFAULTS,
    outgoing=SME_OUTGOING_TRAINABLE + SME_OUTGOING_EXCLUDED,
    incoming=SME_INCOMING_TRAINABLE + SME_INCOMING_EXCLUDED,
    join_counterparty=True,
)

MODELS = {"retail": RETAIL, "sme": SME}


def model_config(name: str) -> ModelConfig | None:
    return MODELS.get(name)
