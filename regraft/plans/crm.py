"""The tables of the CRM model, as specifications.

Fixed values: table and column names, offsets between a target's next id and
the first new one, constants, and the reserved ids each relationship maps to
themselves. They decide the results and are stated here in one place.
"""

from __future__ import annotations

from regraft.plans.spec import TableSpec

CONTACT_OFFSET = 500
MARKER_OFFSET = 10
STAGE_OFFSET = 10
FIELD_OFFSET = 50
OPTION_OFFSET = 50
CATEGORY_OFFSET = 50
INTEREST_OFFSET = 50
DRILLDOWN_TYPE = 23
CONTACT_FORM = -1

CONTACT_IDENTITIES = (0,)
USER_IDENTITIES = (0, -1)
OPTION_IDENTITIES = (0, -1)

DROPDOWN_SETTINGS = (
    "optiontypes",
    "optiontitles",
    "optionsuffixes",
    "optionphonetypes",
    "optionfaxtypes",
)
STAGE_SETTINGS = ("stagewin", "stageloss")
DEFAULT_STAGE_SETTING = "defaultstage"
RECEIPT_SETTINGS = (
    "runPurchaseActionsOnManualOrders",
    "emailinvoiceflag",
    "invoicepayments",
)

PLAN_KEYS = ("ProductId", "Cycle", "Frequency", "NumberOfCycles", "PlanPrice")

CONTACT = TableSpec(
    "Contact",
    offset=CONTACT_OFFSET,
    lookups={
        "CompanyID": "contact",
        "CreatedBy": "user",
        "LastUpdatedBy": "user",
        "OwnerID": "user",
        "LeadSourceId": "lead_source",
    },
    lists={"Groups": "tag"},
    strict_lists=False,
    identities=CONTACT_IDENTITIES,
)

CONTACT_ACTION = TableSpec(
    "ContactAction",
    offset=100,
    parents={"ContactId": "contact"},
    lookups={"UserID": "user", "CreatedBy": "user", "LastUpdatedBy": "user"},
    constants={"OpportunityId": 0, "TemplateId": 0, "FunnelId": 0, "JGraphId": 0},
)

OPPORTUNITY = TableSpec(
    "Opportunity",
    offset=50,
    parents={"ContactID": "contact"},
    lookups={"UserID": "user", "CreatedBy": "user", "LastUpdatedBy": "user"},
    fallbacks={"StageID": "stage"},
    constants={"AffiliateId": 0, "PayPlanId": 0},
)

PRODUCT_INTEREST = TableSpec(
    "ProductInterest",
    offset=INTEREST_OFFSET,
    lookups={"ProductId": "product", "ObjectId": "opportunity", "SubscriptionPlanId": "plan"},
    constants={"LegacyProductId": None},
    numbers_all=True,
    identities=(0,),
)

CREDIT_CARD = TableSpec(
    "CreditCard",
    offset=50,
    parents={"ContactId": "contact"},
    numbers_all=True,
    identities=(0,),
)

JOB_RECURRING = TableSpec(
    "JobRecurring",
    offset=50,
    parents={"ContactId": "contact"},
    lookups={"CC1": "card", "SubscriptionPlanId": "plan", "ProductId": "product"},
    constants={
        "CC2": 0,
        "MerchantAccountId": 0,
        "AffiliateId": 0,
        "LeadAffiliateId": 0,
        "ShippingOptionId": 0,
        "PaymentGatewayId": 0,
        "PaymentSubType": "USE_DEFAULT",
    },
)

JOB_TO_JOB_RECURRING = TableSpec(
    "JobToJobRecurring",
    offset=50,
    parents={"JobId": "job", "JobRecurringId": "subscription"},
    numbers_all=True,
)

ADDRESS = TableSpec("Address", offset=50, lookups={"ContactId": "contact"}, numbers_all=True)

JOB = TableSpec(
    "Job",
    offset=50,
    parents={"ContactId": "contact"},
    lookups={
        "CreatedBy": "user",
        "LastUpdatedBy": "user",
        "ShippingAddressId": "address",
        "InvoiceId": "invoice",
    },
    constants={
        "AffiliateId": 0,
        "LeadAffiliateId": 0,
        "SalesId": 0,
        "TechId": 0,
        "OppId": 0,
        "ProductId": 0,
        "JumpLogId": 0,
        "MarketingEmailId": 0,
        "JobRecurringId": None,
        "LegacyJobRecurringInstanceId": None,
        "FileBoxId": None,
    },
    numbers_all=True,
    identities=(0,),
)

INVOICE = TableSpec(
    "Invoice",
    offset=50,
    parents={"ContactId": "contact", "JobId": "kept_job"},
    lookups={"UserCreate": "user", "PayPlanId": "payplan"},
    lists={"ProductSold": "product"},
    constants={"AffiliateId": 0, "LeadAffiliateId": 0, "MarketingEmailId": 0},
    numbers_all=True,
    identities=(0,),
)

PAY_PLAN = TableSpec(
    "PayPlan",
    offset=50,
    parents={"InvoiceId": "kept_invoice"},
    lookups={"CC1": "card"},
    constants={
        "CC2": 0,
        "MerchantAccountId": 0,
        "PaymentGatewayId": 0,
        "PaymentSubType": "USE_DEFAULT",
        "PayPalRefTxnId": None,
    },
    numbers_all=True,
    identities=(0,),
)

INVOICE_ITEM = TableSpec(
    "InvoiceItem",
    offset=50,
    parents={"ContactId": "contact", "InvoiceId": "kept_invoice", "JobId": "kept_job"},
    lookups={"UserCreate": "user", "OrderItemId": "order_item"},
    constants={"ChargeIds": None, "InvoiceGroup": None},
    numbers_all=True,
    identities=(0,),
)

ORDER_ITEM = TableSpec(
    "OrderItem",
    offset=50,
    parents={"OrderId": "kept_job"},
    lookups={
        "ProductId": "product",
        "InvoiceItemId": "invoice_item",
        "SubscriptionPlanId": "plan",
        "SourceOrderItemId": "order_item",
    },
    constants={"DiscountedOrderItemId": 0},
    numbers_all=True,
    identities=(0,),
)

PAYMENT = TableSpec(
    "Payment",
    offset=50,
    parents={"ContactId": "contact", "InvoiceId": "kept_invoice"},
    lookups={"UserId": "user", "RefundId": "payment"},
    constants={
        "ChargeId": 0,
        "TransactionId": None,
        "CollectionMethod": "MANUAL",
        "PaymentSubType": "MANUAL",
        "PaymentGatewayId": 0,
    },
    numbers_all=True,
    identities=(0,),
)

INVOICE_PAYMENT = TableSpec(
    "InvoicePayment",
    offset=50,
    parents={"InvoiceId": "kept_invoice", "PaymentId": "kept_payment"},
    lookups={"RefundInvoicePaymentId": "invoice_payment"},
    numbers_all=True,
    identities=(0,),
)

PAY_PLAN_ITEM = TableSpec(
    "PayPlanItem",
    offset=50,
    parents={"PayPlanId": "kept_payplan"},
    numbers_all=True,
    identities=(0,),
)

# In the order they are inserted, with the name of each one's relationship.
ORDER_TABLES = {
    "address": ADDRESS,
    "job": JOB,
    "invoice": INVOICE,
    "payplan": PAY_PLAN,
    "invoice_item": INVOICE_ITEM,
    "order_item": ORDER_ITEM,
    "payment": PAYMENT,
    "invoice_payment": INVOICE_PAYMENT,
    "payplan_item": PAY_PLAN_ITEM,
}
