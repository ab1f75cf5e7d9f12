"""The given tables in CRM shape, for a source and a target application.

Each input is one SELECT that both Spark and the checking database read;
``{name}`` refers to a given table or another input. Every input covers its
whole table. The target holds the same records under other ids, some of them
under another natural key, so that part of the source is found there and part
is not. Ids are shifted off 0, which means "unassigned" in this model:
customers become even contact ids and suppliers, who are the users, odd ones.

Order lines repeat (order, line number), so lines are merged on that pair; this
gives them an id, and no order more than seven lines.
"""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from regraft.sources.app import App

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _joined(item: str, order: str) -> str:
    """A comma list in the given order; the one place where the dialects part."""
    return f"<<{item}|{order}>>"


def _list_setting(name: str, value: str, table: str) -> str:
    return (
        f"SELECT '{name}' AS Name, {_joined('v', 'v')} AS Value "
        f"FROM (SELECT DISTINCT {value} AS v FROM {{{table}}}) AS {name}_values"
    )


def _moved(table: str) -> str:
    """Target side of a table that only lends its next free id."""
    return f"SELECT 100000 + 3 * Id AS Id FROM {{{table}}}"


INPUTS: dict[str, str] = {
    # Users and contacts.
    "src_user": """
        SELECT 2 * s_suppkey + 1 AS Id,
               CASE WHEN s_nationkey <> 3 THEN s_suppkey END AS GlobalUserId
        FROM {supplier}""",
    "dst_user": """
        SELECT 100000 + 3 * (2 * s_suppkey + 1) AS Id,
               CASE WHEN s_nationkey = 3 OR s_acctbal < 0 THEN NULL
                    WHEN s_acctbal < 3000 THEN -1 - s_suppkey
                    ELSE s_suppkey END AS GlobalUserId
        FROM {supplier}""",
    "src_contact": """
        SELECT 2 * c_custkey + 2 AS Id,
               CASE WHEN c_acctbal < 0 THEN '' ELSE lower(c_name) || '@example.com' END AS Email,
               0 AS IsUser,
               CASE WHEN c_acctbal > 9000 THEN 2 * c_custkey + 2
                    WHEN c_nationkey < 5 THEN CAST(0 AS BIGINT)
                    ELSE CAST(2 * c_nationkey + 2 AS BIGINT) END AS CompanyID,
               CAST(CASE WHEN c_acctbal < 0 THEN -1 ELSE 2 * c_nationkey + 1 END AS BIGINT) AS CreatedBy,
               CAST(2 * (c_nationkey + 20) + 1 AS BIGINT) AS LastUpdatedBy,
               CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 2 * c_nationkey + 1 END AS BIGINT) AS OwnerID,
               CAST(c_nationkey + 1 AS BIGINT) AS LeadSourceId,
               c_nationkey AS OffSetTimeZone,
               c_name AS FullName
        FROM {customer}
        UNION ALL
        SELECT 2 * s_suppkey + 1,
               CASE WHEN s_acctbal < 500 THEN '' ELSE lower(s_name) || '@example.com' END,
               1, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT),
               CAST(0 AS BIGINT), s_nationkey, s_name
        FROM {supplier}""",
    "dst_contact": """
        SELECT 100000 + 3 * Id AS Id,
               CASE WHEN IsUser = 1 AND OffSetTimeZone > 12 THEN 'moved-' || Email ELSE Email END AS Email,
               IsUser,
               CASE WHEN CompanyID = 0 THEN CompanyID ELSE 100000 + 3 * CompanyID END AS CompanyID
        FROM {src_contact}""",
    "src_company_owner": """
        SELECT 2 * c_custkey + 2 AS Id,
               CAST(CASE WHEN c_nationkey = 7 THEN 2 * c_nationkey + 1 ELSE 2 * c_nationkey + 2 END AS BIGINT)
                   AS MainContactId,
               c_name AS CompanyName
        FROM {customer}
        WHERE c_acctbal > 9000""",
    "dst_company_owner": """
        SELECT 100000 + 3 * Id AS Id, 100000 + 3 * MainContactId AS MainContactId, CompanyName
        FROM {src_company_owner}""",
    # Lead sources.
    "src_lead_source_category": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS Id, r_name AS Name FROM {region}""",
    "dst_lead_source_category": """
        SELECT 100000 + 3 * Id AS Id, CASE WHEN Id < 3 THEN Name ELSE Name || ' (old)' END AS Name
        FROM {src_lead_source_category}""",
    "src_lead_source": """
        SELECT CAST(n_nationkey + 1 AS BIGINT) AS Id, n_name AS Name,
               CAST(CASE WHEN n_nationkey = 8 THEN 0 WHEN n_nationkey = 9 THEN 77
                         ELSE n_regionkey + 1 END AS BIGINT) AS LeadSourceCategoryId
        FROM {nation}""",
    "dst_lead_source": """
        SELECT 100000 + 3 * Id AS Id, CASE WHEN Id > 15 THEN Name ELSE lower(Name) END AS Name,
               100000 + 3 * LeadSourceCategoryId AS LeadSourceCategoryId
        FROM {src_lead_source}""",
    # Tags and their applications.
    "src_tag_category": """
        SELECT DISTINCT
               CAST(CASE event_type WHEN 'error' THEN 2 WHEN 'signup' THEN 3 ELSE 1 END AS BIGINT) AS Id,
               CASE event_type WHEN 'error' THEN 'system' WHEN 'signup' THEN 'onboarding'
                    ELSE 'engage' END AS CategoryName
        FROM {events}""",
    "dst_tag_category": """
        SELECT 100000 + 3 * Id AS Id,
               CASE WHEN CategoryName = 'engage' THEN CategoryName ELSE upper(CategoryName) END AS CategoryName
        FROM {src_tag_category}""",
    "src_tag": """
        SELECT min(event_id) + 1 AS Id, event_type AS GroupName,
               CAST(CASE event_type WHEN 'error' THEN 2 WHEN 'signup' THEN 0 ELSE 1 END AS BIGINT)
                   AS GroupCategoryId,
               'from ' || event_type AS GroupDescription,
               CAST(0 AS BIGINT) AS ImportId
        FROM {events} GROUP BY event_type""",
    "dst_tag": """
        SELECT 100000 + 3 * Id AS Id,
               CASE WHEN GroupName IN ('click', 'error') THEN GroupName ELSE upper(GroupName) END AS GroupName,
               100000 + 3 * GroupCategoryId AS GroupCategoryId, GroupDescription, ImportId
        FROM {src_tag}""",
    "src_tag_application": """
        SELECT event_id + 1 AS Id,
               CASE WHEN value > 100 THEN NULL WHEN value > 60 THEN 2 * user_id + 1
                    ELSE 2 * user_id + 2 END AS ContactId,
               t.Id AS GroupId, ts AS DateCreated
        FROM {events} AS e JOIN {src_tag} AS t ON e.event_type = t.GroupName""",
    "dst_tag_application": """
        SELECT 100000 + 3 * (event_id + 1) AS Id,
               CASE WHEN value > 90 THEN NULL ELSE 100000 + 3 * (2 * user_id + 2) END AS ContactId,
               CASE WHEN value < 2 THEN 100000 + 3 * t.Id ELSE CAST(7 AS BIGINT) END AS GroupId,
               ts AS DateCreated
        FROM {events} AS e JOIN {src_tag} AS t ON e.event_type = t.GroupName""",
    "contact_groups": f"""
        SELECT ContactId, {_joined('CAST(GroupId AS STRING)', 'GroupId')} || ',x, 7' AS Groups
        FROM (SELECT DISTINCT ContactId, GroupId FROM {{src_tag_application}}
              WHERE ContactId IS NOT NULL) AS applied
        GROUP BY ContactId""",
    "src_contact_grouped": """
        SELECT c.*, CASE WHEN c.OffSetTimeZone = 1 THEN '' ELSE g.Groups END AS Groups
        FROM {src_contact} AS c LEFT JOIN {contact_groups} AS g ON c.Id = g.ContactId""",
    "src_action": """
        SELECT event_id + 1 AS Id,
               CASE WHEN value > 100 THEN NULL WHEN value > 60 THEN 2 * user_id + 1
                    WHEN value < 1 THEN CAST(0 AS BIGINT) ELSE 2 * user_id + 2 END AS ContactId,
               CASE WHEN event_type = 'view' THEN CAST(0 AS BIGINT) ELSE 2 * user_id + 1 END AS UserID,
               CAST(-1 AS BIGINT) AS CreatedBy, 2 * user_id + 3 AS LastUpdatedBy,
               CAST(5 AS BIGINT) AS OpportunityId, CAST(5 AS BIGINT) AS TemplateId,
               CAST(5 AS BIGINT) AS FunnelId, CAST(5 AS BIGINT) AS JGraphId,
               event_type AS ActionType, props AS Notes, ts AS ActionDate
        FROM {events}""",
    "dst_action": _moved("src_action"),
    "staged_card": """
        SELECT c_custkey + 1 AS Id,
               CASE WHEN c_nationkey = 4 THEN CAST(2 * c_nationkey + 1 AS BIGINT)
                    WHEN c_nationkey = 5 THEN CAST(0 AS BIGINT)
                    ELSE 2 * c_custkey + 2 END AS ContactId,
               c_mktsegment AS CardType
        FROM {customer}""",
    "dst_card": _moved("staged_card"),
    # Products.
    "src_product": """
        SELECT p_partkey + 1 AS Id,
               CASE WHEN p_retailprice > 900 THEN
                    p_name || '|' || p_brand || '|' || p_type || '|' || CAST(p_size AS STRING)
               END AS ProductName,
               p_brand AS Sku, CAST(p_retailprice AS DECIMAL(12, 2)) AS Price
        FROM {part}""",
    "dst_product": """
        SELECT 100000 + 3 * (p_partkey + 1) AS Id,
               CASE WHEN p_retailprice > 900 THEN
                    p_name || '|' || p_brand || '|' || p_type || '|' || CAST(p_size AS STRING)
                    || CASE WHEN p_size > 17 THEN ' (retired)' ELSE '' END
               END AS ProductName
        FROM {part}""",
    "src_plan": """
        SELECT p_partkey + 1 AS Id,
               CASE WHEN p_brand = 'Brand#9' THEN -1 - p_partkey ELSE p_partkey + 1 END AS ProductId,
               CAST(CASE WHEN p_size < 10 THEN NULL WHEN p_size < 30 THEN 1 ELSE 2 END AS BIGINT) AS Cycle,
               CAST(CASE WHEN p_type = 'SMALL' THEN NULL ELSE 1 END AS BIGINT) AS Frequency,
               CAST(p_size AS BIGINT) AS NumberOfCycles,
               CAST(p_retailprice AS DECIMAL(12, 2)) AS PlanPrice
        FROM {part}""",
    "dst_plan": """
        SELECT 100000 + 3 * Id AS Id, 100000 + 3 * ProductId AS ProductId,
               coalesce(Cycle, 0) AS Cycle, Frequency, NumberOfCycles,
               CASE WHEN NumberOfCycles < 8 THEN CAST(PlanPrice + 1 AS DECIMAL(12, 2)) ELSE PlanPrice END AS PlanPrice
        FROM {src_plan}""",
    "src_product_category": """
        SELECT 2 * min(p_partkey) + 2 AS Id, p_type AS CategoryDisplayName, CAST(NULL AS BIGINT) AS ParentId
        FROM {part} GROUP BY p_type
        UNION ALL
        SELECT 2 * b.first_part + 1, b.p_type || '/' || b.p_brand, 2 * t.first_part + 2
        FROM (SELECT p_type, p_brand, min(p_partkey) AS first_part FROM {part} GROUP BY p_type, p_brand) AS b
        JOIN (SELECT p_type, min(p_partkey) AS first_part FROM {part} GROUP BY p_type) AS t
          ON b.p_type = t.p_type""",
    "dst_product_category": """
        SELECT 100000 + 3 * Id AS Id,
               CASE WHEN CategoryDisplayName LIKE 'ECONOMY%' THEN CategoryDisplayName
                    ELSE CategoryDisplayName || ' (old)' END AS CategoryDisplayName
        FROM {src_product_category}""",
    "src_part": """
        SELECT p_partkey + 1 AS Id, CASE WHEN p_retailprice > 900 THEN p_name END AS Name,
               p_brand AS Brand, CAST(CASE WHEN p_size > 40 THEN NULL ELSE p_size END AS BIGINT) AS Size,
               CAST(p_retailprice AS DECIMAL(12, 2)) AS Price
        FROM {part}""",
    "dst_part": """
        SELECT 100000 + 3 * Id AS Id, CASE WHEN Name LIKE 'red%' THEN NULL ELSE Name END AS Name,
               Brand, Size, CASE WHEN Brand = 'Brand#7' THEN NULL ELSE Price END AS Price
        FROM {src_part}""",
    # Opportunities.
    "src_stage": """
        SELECT min(o_orderkey) + 1 AS Id, o_orderstatus AS StageName, 4 AS StageOrder
        FROM {orders} GROUP BY o_orderstatus""",
    "dst_stage": """
        SELECT 100000 + 3 * Id AS Id,
               CASE WHEN StageName = 'F' THEN StageName ELSE lower(StageName) END AS StageName, StageOrder
        FROM {src_stage}""",
    "src_opportunity": """
        SELECT o_orderkey + 1 AS Id,
               CASE WHEN o_totalprice > 450000 THEN 2 * o_custkey + 1
                    WHEN o_totalprice < 5000 THEN CAST(0 AS BIGINT) ELSE 2 * o_custkey + 2 END AS ContactID,
               CASE WHEN o_orderpriority = '5-LOW' THEN CAST(-5 AS BIGINT) ELSE s.Id END AS StageID,
               CAST(2 * CAST(substr(o_orderpriority, 1, 1) AS BIGINT) + 1 AS BIGINT) AS UserID,
               CAST(-1 AS BIGINT) AS CreatedBy, CAST(0 AS BIGINT) AS LastUpdatedBy,
               CAST(8 AS BIGINT) AS AffiliateId, CAST(8 AS BIGINT) AS PayPlanId,
               o_totalprice AS Amount, o_orderdate AS DateCreated
        FROM {orders} AS o JOIN {src_stage} AS s ON o.o_orderstatus = s.StageName""",
    "dst_opportunity": "SELECT 100000 + 3 * (o_orderkey + 1) AS Id FROM {orders}",
    "src_interest": """
        SELECT Id, CASE WHEN LineNumber = 7 THEN 'Contact' ELSE 'Opportunity' END AS ObjType,
               OrderId AS ObjectId, ProductId, ProductId AS SubscriptionPlanId, CAST(3 AS BIGINT) AS LegacyProductId
        FROM {line_base}""",
    # Settings.
    "src_setting": "\nUNION ALL\n".join(
        [
            _list_setting("optiontypes", "event_type", "events"),
            _list_setting("optiontitles", "c_mktsegment", "customer"),
            _list_setting("optionsuffixes", "o_orderpriority", "orders"),
            _list_setting("optionphonetypes", "p_type", "part"),
            _list_setting("optionfaxtypes", "l_returnflag", "lineitem"),
            "SELECT 'stagewin', CAST(max(Id) AS STRING) FROM {src_stage} WHERE StageName = 'F'",
            "SELECT 'stageloss', '' FROM {src_stage} WHERE StageName = 'F'",
        ]
    ),
    "dst_setting": "\nUNION ALL\n".join(
        [
            _list_setting("optiontypes", "upper(event_type)", "events"),
            _list_setting("optiontitles", "c_mktsegment", "customer"),
            _list_setting(
                "optionsuffixes",
                "CASE WHEN o_totalprice > 250000 THEN o_orderpriority ELSE 'none' END",
                "orders",
            ),
            _list_setting("optionphonetypes", "CASE WHEN p_size < 9 THEN p_type ELSE p_brand END", "part"),
            _list_setting("optionfaxtypes", "l_linestatus", "lineitem"),
            "SELECT 'defaultstage', CAST(min(Id) AS STRING) FROM {dst_stage}",
            "SELECT 'stagewin', '1' FROM {dst_stage} WHERE StageName = 'F'",
            "SELECT 'stageloss', '2' FROM {dst_stage} WHERE StageName = 'F'",
            "SELECT 'runPurchaseActionsOnManualOrders', CASE WHEN count(*) > 0 THEN '1' ELSE '0' END FROM {orders}",
            "SELECT 'emailinvoiceflag', CASE WHEN count(*) > 0 THEN '1' ELSE '0' END FROM {lineitem}",
            "SELECT 'invoicepayments', CASE WHEN count(*) > 0 THEN 'never' ELSE '1' END FROM {customer}",
            "SELECT 'untouched', CASE WHEN count(*) > 0 THEN '1' ELSE '0' END FROM {customer}",
        ]
    ),
    # Orders and what belongs to them.
    "order_base": """
        SELECT o_orderkey + 1 AS Id,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 2 * o_custkey + 1
                    WHEN o_totalprice < 3000 THEN CAST(0 AS BIGINT)
                    ELSE 2 * o_custkey + 2 END AS ContactId,
               2 * CAST(substr(o_orderpriority, 1, 1) AS BIGINT) + 1 AS StaffId,
               o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate
        FROM {orders}""",
    # every line of its own, by its place in the order
    "line_base": """
        SELECT l_orderkey * 1048576 + place AS Id, l_orderkey + 1 AS OrderId, place AS LineNumber,
               l_partkey + 1 AS ProductId, l_suppkey AS SupplierKey,
               CAST(l_quantity AS BIGINT) AS Qty, CAST(1 AS BIGINT) AS Lines
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY l_orderkey
                  ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                           l_returnflag, l_linestatus, l_shipdate) AS place
              FROM {lineitem}) AS numbered""",
    "src_address": """
        SELECT c_custkey + 1 AS Id,
               CASE WHEN c_nationkey = 6 THEN CAST(-3 AS BIGINT) ELSE 2 * c_custkey + 2 END AS ContactId,
               c_name AS Street
        FROM {customer}""",
    "src_job": """
        SELECT Id, ContactId, StaffId AS CreatedBy, CAST(0 AS BIGINT) AS LastUpdatedBy,
               o_custkey + 1 AS ShippingAddressId, Id AS InvoiceId,
               CAST(7 AS BIGINT) AS AffiliateId, CAST(7 AS BIGINT) AS LeadAffiliateId,
               CAST(7 AS BIGINT) AS SalesId, CAST(7 AS BIGINT) AS TechId, CAST(7 AS BIGINT) AS OppId,
               CAST(7 AS BIGINT) AS ProductId, CAST(7 AS BIGINT) AS JumpLogId,
               CAST(7 AS BIGINT) AS MarketingEmailId, CAST(7 AS BIGINT) AS JobRecurringId,
               CAST(7 AS BIGINT) AS LegacyJobRecurringInstanceId, CAST(7 AS BIGINT) AS FileBoxId,
               o_orderpriority AS JobNotes, o_orderdate AS DateCreated
        FROM {order_base}""",
    "product_sold": f"""
        SELECT OrderId, ' ' || {_joined('CAST(ProductId AS STRING)', 'LineNumber')} || ',-4' AS ProductSold
        FROM {{line_base}} GROUP BY OrderId""",
    "src_invoice": """
        SELECT b.Id, ContactId,
               CASE WHEN o_totalprice > 490000 THEN CAST(0 AS BIGINT) ELSE b.Id END AS JobId,
               CASE WHEN o_orderstatus = 'F' THEN CAST(0 AS BIGINT) ELSE b.Id END AS PayPlanId,
               StaffId AS UserCreate, ProductSold,
               CAST(6 AS BIGINT) AS AffiliateId, CAST(6 AS BIGINT) AS LeadAffiliateId,
               CAST(6 AS BIGINT) AS MarketingEmailId, o_totalprice AS InvoiceTotal
        FROM {order_base} AS b LEFT JOIN {product_sold} AS p ON b.Id = p.OrderId""",
    "src_payplan": """
        SELECT Id, Id AS InvoiceId,
               CASE WHEN o_orderstatus = 'O' THEN CAST(0 AS BIGINT) ELSE o_custkey + 1 END AS CC1,
               CAST(6 AS BIGINT) AS CC2, CAST(6 AS BIGINT) AS MerchantAccountId,
               CAST(6 AS BIGINT) AS PaymentGatewayId, 'OTHER' AS PaymentSubType,
               'ref' AS PayPalRefTxnId, o_totalprice AS AmountDue
        FROM {order_base}""",
    "src_invoice_item": """
        SELECT Id, OrderId AS InvoiceId, OrderId AS JobId, 2 * SupplierKey + 2 AS ContactId,
               2 * SupplierKey + 1 AS UserCreate, Id AS OrderItemId,
               'c' AS ChargeIds, 'g' AS InvoiceGroup, Qty, Lines
        FROM {line_base}""",
    "src_order_item": """
        SELECT Id, OrderId, ProductId, Id AS InvoiceItemId, ProductId AS SubscriptionPlanId,
               CASE WHEN LineNumber = 1 THEN CAST(0 AS BIGINT) ELSE Id - 1 END AS SourceOrderItemId,
               CAST(9 AS BIGINT) AS DiscountedOrderItemId, Qty
        FROM {line_base}""",
    "src_payment": """
        SELECT Id, ContactId, Id AS InvoiceId, StaffId AS UserId,
               CASE WHEN o_orderstatus = 'P' THEN Id - 1 ELSE CAST(0 AS BIGINT) END AS RefundId,
               CAST(6 AS BIGINT) AS ChargeId, CAST(6 AS BIGINT) AS TransactionId,
               'CARD' AS CollectionMethod, 'CARD' AS PaymentSubType,
               CAST(6 AS BIGINT) AS PaymentGatewayId, o_totalprice AS Amount
        FROM {order_base}""",
    "src_invoice_payment": """
        SELECT Id, Id AS InvoiceId, Id AS PaymentId,
               CASE WHEN o_orderstatus = 'P' THEN Id - 1 ELSE CAST(0 AS BIGINT) END AS RefundInvoicePaymentId,
               o_totalprice AS Amount
        FROM {order_base}""",
    "src_payplan_item": """
        SELECT Id, Id AS PayPlanId, o_orderdate AS DateDue FROM {order_base}""",
    "src_subscription": """
        SELECT Id, ContactId, o_custkey + 1 AS CC1, CAST(6 AS BIGINT) AS CC2,
               CAST(6 AS BIGINT) AS MerchantAccountId, CAST(6 AS BIGINT) AS AffiliateId,
               CAST(6 AS BIGINT) AS LeadAffiliateId, o_custkey + 1 AS SubscriptionPlanId,
               o_custkey + 1 AS ProductId, CAST(6 AS BIGINT) AS ShippingOptionId,
               CAST(6 AS BIGINT) AS PaymentGatewayId, 'OTHER' AS PaymentSubType, o_orderdate AS StartDate
        FROM {order_base}""",
    "src_order_subscription": """
        SELECT Id, OrderId AS JobId, SupplierKey + 1 AS JobRecurringId, Qty FROM {line_base}""",
    **{
        f"dst_{t}": "SELECT 100000 + 3 * (o_orderkey + 1) AS Id FROM {orders}"
        for t in (
            "job", "invoice", "payplan", "payment", "invoice_payment", "payplan_item", "subscription",
        )
    },
    **{
        f"dst_{t}": "SELECT 100000 + 3 * (l_orderkey * 10 + l_linenumber) AS Id FROM {lineitem}"
        for t in ("invoice_item", "order_item", "order_subscription", "interest")
    },
    "dst_address": _moved("src_address"),
    # Custom fields. The definitions are metadata; the values cover all customers.
    "src_form_tab": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS Id,
               CAST(CASE WHEN r_regionkey = 4 THEN -2 ELSE -1 END AS BIGINT) AS FormId, r_name AS TabName
        FROM {region}""",
    "dst_form_tab": """
        SELECT 100000 + 3 * Id AS Id, FormId,
               CASE WHEN Id < 3 THEN TabName ELSE lower(TabName) END AS TabName
        FROM {src_form_tab}""",
    "src_form_group": """
        SELECT CAST(n_nationkey + 1 AS BIGINT) AS Id, CAST(n_regionkey + 1 AS BIGINT) AS TabId,
               n_name AS GroupName
        FROM {nation}""",
    "dst_form_group": """
        SELECT 100000 + 3 * Id AS Id, 100000 + 3 * TabId AS TabId,
               CASE WHEN Id > 20 THEN lower(GroupName) ELSE GroupName END AS GroupName
        FROM {src_form_group}""",
    "src_form_field": """
        SELECT CAST(n_nationkey + 1 AS BIGINT) AS Id,
               CAST(CASE WHEN n_nationkey > 3 THEN -2 ELSE -1 END AS BIGINT) AS FormId,
               CAST(n_nationkey + 1 AS BIGINT) AS GroupId,
               CASE n_nationkey WHEN 0 THEN 'Market' WHEN 1 THEN 'Balance' WHEN 2 THEN 'Home'
                    WHEN 3 THEN 'Code' ELSE n_name END AS DisplayName,
               CAST(CASE n_nationkey WHEN 2 THEN 23 ELSE 1 END AS BIGINT) AS DataType,
               CASE n_nationkey WHEN 0 THEN 'Segment' WHEN 1 THEN 'Balance' WHEN 2 THEN 'Nation'
                    WHEN 3 THEN 'Code9' ELSE 'Other' END AS FieldName
        FROM {nation}""",
    "dst_form_field": """
        SELECT 100000 + 3 * Id AS Id, FormId, GroupId,
               CASE WHEN Id IN (1, 3) THEN DisplayName ELSE DisplayName || ' (old)' END AS DisplayName,
               DataType, CASE WHEN Id = 1 THEN 'MarketSegment' ELSE FieldName END AS FieldName
        FROM {src_form_field}""",
    "src_custom": """
        SELECT 2 * c_custkey + 2 AS Id, c_mktsegment AS Segment, c_acctbal AS Balance,
               CAST(c_nationkey + 1 AS DOUBLE) AS Nation, CAST(c_nationkey AS BIGINT) AS Code9,
               c_name AS NoField
        FROM {customer}""",
    "dst_custom": """
        SELECT 100000 + 3 * Id AS Id, Segment AS MarketSegment, Balance,
               CAST(CAST(Nation AS BIGINT) AS STRING) AS Nation, Code9
        FROM {src_custom}""",
    "src_option": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS Id, CAST(0 AS BIGINT) AS CategoryId,
               '3.0' AS FieldId, r_name AS Label
        FROM {region}
        UNION ALL
        SELECT CAST(n_nationkey + 101 AS BIGINT), CAST(n_regionkey + 1 AS BIGINT),
               CASE WHEN n_nationkey = 24 THEN '99' ELSE '3' END, n_name
        FROM {nation}""",
    "dst_option": """
        SELECT 100000 + 3 * Id AS Id, CategoryId, '100009' AS FieldId,
               CASE WHEN Id < 4 OR Id > 115 THEN Label ELSE lower(Label) END AS Label
        FROM {src_option}""",
}

# Table names of the two applications.
SHAPES = {
    "User": "user",
    "Contact": "contact",
    "CompanyOwner": "company_owner",
    "LeadSourceCategory": "lead_source_category",
    "LeadSource": "lead_source",
    "ContactGroupCategory": "tag_category",
    "ContactGroup": "tag",
    "ContactGroupAssign": "tag_application",
    "ContactAction": "action",
    "CreditCard": "card",
    "Product": "product",
    "SubscriptionPlan": "plan",
    "ProductCategory": "product_category",
    "Stage": "stage",
    "Opportunity": "opportunity",
    "ProductInterest": "interest",
    "AppSetting": "setting",
    "Address": "address",
    "Job": "job",
    "Invoice": "invoice",
    "PayPlan": "payplan",
    "InvoiceItem": "invoice_item",
    "OrderItem": "order_item",
    "Payment": "payment",
    "InvoicePayment": "invoice_payment",
    "PayPlanItem": "payplan_item",
    "JobRecurring": "subscription",
    "JobToJobRecurring": "order_subscription",
    "DataFormTab": "form_tab",
    "DataFormGroup": "form_group",
    "DataFormField": "form_field",
    "Custom_Contact": "custom",
    "DrilldownOption": "option",
}


def references(text: str) -> list[str]:
    """Names in braces, each once, in order."""
    return list(dict.fromkeys(name for _, name, _, _ in Formatter().parse(text) if name))


def in_dialect(text: str, duck: bool) -> str:
    while "<<" in text:
        head, rest = text.split("<<", 1)
        inner, tail = rest.split(">>", 1)
        item, order = inner.split("|")
        made = (
            f"string_agg({item}, ',' ORDER BY {order})"
            if duck
            else f"listagg({item}, ',') WITHIN GROUP (ORDER BY {order})"
        )
        text = head + made + tail
    return text


class Inputs:
    """The inputs as DataFrames over one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def frame(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                self._frames[name] = self.sql(INPUTS[name])
        return self._frames[name]

    __getitem__ = frame

    def once(self, name: str, keep: Callable[[str, DataFrame], DataFrame]) -> None:
        """Write an input before several others read it, so that it is derived once."""
        self._frames[name] = keep(name, self.frame(name))

    def sql(self, text: str) -> DataFrame:
        used = {name: self.frame(name) for name in references(text)}
        return self.spark.sql(in_dialect(text, duck=False), **used)

    def source(self) -> App:
        return App("src", lambda table: self.frame(f"src_{SHAPES[table]}"))

    def source_with_groups(self) -> App:
        return self.source().replaced(Contact=self.frame("src_contact_grouped"))

    def target(self) -> App:
        def read(table: str) -> DataFrame:
            if table.startswith("CreditCard_from_"):
                return self.frame("staged_card")
            return self.frame(f"dst_{SHAPES[table]}")

        return App("dst", read)


def with_inputs(text: str, extra: dict[str, str] | None = None) -> str:
    """The statement for the checking database, inputs in front as a WITH list."""
    known = {**INPUTS, **(extra or {})}
    ordered: list[str] = []

    def visit(statement: str) -> None:
        for name in references(statement):
            if name in known and name not in ordered:
                visit(known[name])
                if name not in ordered:
                    ordered.append(name)

    visit(text)
    plain = {n: n for n in (*TABLES, *known)}
    parts = [f"{n} AS ({known[n].format(**plain)})" for n in ordered]
    body = text.format(**plain)
    own = body.strip()
    if own.startswith("WITH "):
        parts, own = [*parts, own[5:]], ""
    whole = f"WITH {', '.join(parts)} {own}" if parts else own
    return in_dialect(whole, duck=True)
