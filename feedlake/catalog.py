"""The packaged entities: path, paging, selector, and the schema their records land with."""

from __future__ import annotations

import re
from collections.abc import Collection
from dataclasses import dataclass, field
from enum import StrEnum
from typing import Any

from pyspark.sql import types as T

from .errors import ValidationError
from .functions.lattice import joined
from .functions.selector import Selector, entries


class Pagination(StrEnum):
    """How requests for an entity are cut: one offset-paged scope, or one scope per month."""

    OFFSET = "offset"
    DATE_WINDOW = "date_window"


@dataclass(frozen=True)
class EntitySpec:
    """What a read asks for. ``schema`` overrides the schema derived from the selector."""

    path: str
    fields: Selector
    changed_since: bool
    pagination: Pagination = Pagination.OFFSET
    explode_columns: tuple[str, ...] = ()
    stable_sort_field: str | None = "id"
    schema: T.StructType | None = field(default=None, compare=False)

    def record_schema(self, found: T.StructType | None = None) -> T.StructType:
        """Schema of one record: the given one, else that of the landed records, else a guess from the names."""
        if self.schema or found is None:
            return self.schema or derive_schema(self.fields, self.explode_columns, self.path)
        return complete_schema(found, self.fields, self.explode_columns, self.path)


def entity_from_metadata(name: str, payload: dict[str, Any]) -> EntitySpec:
    """Build a spec from a metadata mapping; ``explode_columns`` and ``stable_sort_field`` are optional."""
    try:
        return EntitySpec(
            path=payload["path"],
            fields=payload["fields"],
            changed_since=payload["changed_since"],
            pagination=Pagination(payload["pagination"]),
            explode_columns=tuple(payload.get("explode_columns", ())),
            stable_sort_field=payload.get("stable_sort_field", "id"),
        )
    except (KeyError, ValueError, TypeError) as exc:
        raise ValidationError(f"invalid metadata for entity {name!r}: {exc!r}", entity=name) from exc


# The source declares no types. This one table guesses them from the names; first match wins.
# Numbers land as double, the value a JSON number has; dates stay text until a caller casts them.
_TYPE_RULES: tuple[tuple[str, T.DataType], ...] = (
    (r"id|row|year|.*Id", T.LongType()),
    (r"(is|requires?|uses?|has|allow)[A-Z].*|vatLocked|systemGenerated|matched|forParticipantsOnly|showProducts"
     r"|generalProjectActivitiesPerProjectOnly|ignoreCompanyProductDiscountAgreement|singleCustomerInvoice"
     r"|invoiceSendSMSNotification", T.BooleanType()),
    (r"amount.*|.*Amount.*|.*Price.*|price.*|balance.*|cost.*|.*[pP]ercent(age)?|factor|fixedprice|basis|profit"
     r"|expenses|markUp.*|weight|volume|stockOfGoods", T.DoubleType()),
    (r"numberOf.*|hierarchyLevel|invoicesDueIn|invoiceDueDate|customerNumber|supplierNumber", T.LongType()),
)
# Names that the rules get wrong, plain or within their group or path.
_EXCEPTIONS: dict[str, T.DataType] = {
    "isAuthProjectOverviewURL": T.StringType(),
    "account.number": T.LongType(),
    "ledger/account.number": T.LongType(),
}

# Guesses for a read that lands no record to tell: groups that hold a list of objects (the exploding entity proves the first,
# the rest go by their plural names), and what an object that is requested whole has at least.
LIST_GROUPS = frozenset({
    "bankAccountPresentation", "employments", "holidayAllowanceEarned", "legalVatTypes", "orderLines",
    "projectHourlyRates", "participants", "projectActivities",
})
WHOLE_OBJECTS = {"account": ("id", "number", "name")}


def derive_schema(selector: Selector, lists: Collection[str] = (), owner: str = "") -> T.StructType:
    """The landing schema of a selector, by the naming rules above; ``owner`` is its path or group."""
    fields = []
    for name, kids in entries(selector):
        if kids is None:
            dtype = _plain_type(name, owner)
        else:
            dtype = derive_schema(kids, owner=name)
            if name in LIST_GROUPS or name in lists:
                dtype = T.ArrayType(dtype)
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


def _plain_type(name: str, owner: str) -> T.DataType:
    if name in WHOLE_OBJECTS:
        return derive_schema(list(WHOLE_OBJECTS[name]), owner=name)
    for known in (f"{owner}.{name}", name):
        if known in _EXCEPTIONS:
            return _EXCEPTIONS[known]
    return next((dtype for rule, dtype in _TYPE_RULES if re.fullmatch(rule, name)), T.StringType())


def complete_schema(found: T.StructType, selector: Selector, lists: Collection[str] = (), owner: str = "") -> T.StructType:
    """The schema of records of type ``found`` under a selector: what a field holds comes from the records, be it an object, a
    list or a value, and a field that is selected whole keeps all its parts. The guess is left for what no record has
    shown, and widens whole numbers where the name promises others.
    """
    have = {f.name: f.dataType for f in found}
    guesses = derive_schema(selector, lists, owner)
    fields = []
    for name, kids in entries(selector):
        seen, guess = have.get(name, T.NullType()), guesses[name].dataType
        dtype = _whole(seen, guess, name) if kids is None else _group(seen, guess, kids, name)
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


def _whole(found: T.DataType, guess: T.DataType, owner: str) -> T.DataType:
    if isinstance(found, T.NullType):
        return guess
    if isinstance(found, T.ArrayType):
        return T.ArrayType(_whole(found.elementType, T.StringType(), owner))
    if isinstance(found, T.StructType):
        return T.StructType([T.StructField(f.name, _whole(f.dataType, _plain_type(f.name, owner), f.name)) for f in found])
    return joined(found, guess) if isinstance(found, T.NumericType) and isinstance(guess, T.NumericType) else found


def _group(found: T.DataType, guess: T.DataType, kids: Selector, owner: str) -> T.DataType:
    if isinstance(found, T.ArrayType):
        return T.ArrayType(_group(found.elementType, guess.elementType if isinstance(guess, T.ArrayType) else guess, kids, owner))
    if isinstance(found, T.StructType):
        return complete_schema(found, kids, owner=owner)
    return guess if isinstance(found, T.NullType) else found


def _offset(path: str, fields: Selector, *, changed_since: bool = False, explode: tuple[str, ...] = ()) -> EntitySpec:
    return EntitySpec(path, fields, changed_since, Pagination.OFFSET, explode)


def _windowed(path: str, fields: Selector, sort_field: str = "id") -> EntitySpec:
    return EntitySpec(path, fields, False, Pagination.DATE_WINDOW, (), sort_field)


# Entity names, request paths and field selectors, as the remote API spells them.
CATALOG: dict[str, EntitySpec] = {
    "customer": _offset("customer", [
        "id", "name", "organizationNumber", "supplierNumber", "customerNumber", "isSupplier", "isCustomer", "isInactive",
        {"accountManager": ["id"]}, {"department": ["id"]}, "email", "invoiceEmail", "overdueNoticeEmail", "phoneNumber",
        "phoneNumberMobile", "description", "language", "displayName", "isPrivateIndividual", "singleCustomerInvoice",
        "invoiceSendMethod", "emailAttachmentType", {"postalAddress": ["id"]}, {"physicalAddress": ["id"]},
        {"deliveryAddress": ["id"]}, {"category1": ["id"]}, {"category2": ["id"]}, {"category3": ["id"]}, "invoicesDueIn",
        "invoicesDueInType", {"currency": ["id"]},
        {"bankAccountPresentation": ["iban", "bban", "bic", {"country": ["id"]}, "provider"]}, {"ledgerAccount": ["id"]},
        "isFactoring", "invoiceSendSMSNotification", "isAutomaticSoftReminderEnabled", "isAutomaticReminderEnabled",
        "isAutomaticNoticeOfDebtCollectionEnabled", "discountPercentage", "website",
    ], changed_since=True),
    "customer_lite": _offset("customer", [
        "id", "name", "customerNumber", "organizationNumber", "language", "isInactive",
    ], changed_since=True),
    "department": _offset("department", [
        "id", "name", "departmentNumber", {"departmentManager": ["id"]}, "displayName", "isInactive",
    ]),
    "department_lite": _offset("department", ["id", "name", "departmentNumber", "isInactive"]),
    "employee": _offset("employee", [
        "id", "firstName", "lastName", "displayName", "employeeNumber", "dateOfBirth", "email",
        {"phoneNumberMobileCountry": ["id"]}, "phoneNumberMobile", "phoneNumberHome", "phoneNumberWork",
        "nationalIdentityNumber", "dnumber", {"internationalId": ["intAmeldingType", {"country": ["id"]}, "number"]},
        "bankAccountNumber", "iban", "bic", "creditorBankCountryId", "usesAbroadPayment", "userType",
        "allowInformationRegistration", "isContact", "comments", {"address": ["id"]}, {"department": ["id"]},
        {"employments": ["id"]}, {"holidayAllowanceEarned": ["year", "amount", "basis", "amountExtraHolidayWeek"]},
        {"employeeCategory": ["id"]}, "isAuthProjectOverviewURL", "pictureId", "companyId",
    ]),
    "employee_lite": _offset("employee", ["id", "displayName", "employeeNumber"]),
    "ledger_account": _offset("ledger/account", [
        "id", "number", "name", "description", "type", {"legalVatTypes": ["id"]}, "ledgerType", {"vatType": ["id"]},
        "vatLocked", {"currency": ["id"]}, "isCloseable", "isApplicableForSupplierInvoice", "requireReconciliation",
        "isInactive", "isBankAccount", "isInvoiceAccount", "bankAccountNumber", {"bankAccountCountry": ["id"]}, "bankName",
        "bankAccountIBAN", "bankAccountSWIFT", "saftCode", "displayName", "requiresDepartment", "requiresProject",
        {"invoicingDepartment": ["id"]}, "isPostingsExist",
    ]),
    "ledger_account_lite": _offset("ledger/account", ["id", "number", "name", "isInactive", "saftCode"]),
    "ledger_posting": _windowed("ledger/posting", [
        "id", {"voucher": ["id"]}, "date", "description", {"account": ["id"]}, {"amortizationAccount": ["id"]},
        "amortizationStartDate", "amortizationEndDate", {"customer": ["id"]}, {"supplier": ["id"]}, {"employee": ["id"]},
        {"project": ["id"]}, {"product": ["id"]}, {"department": ["id"]}, {"vatType": ["id"]}, "amount", "amountCurrency",
        "amountGross", "amountGrossCurrency", {"currency": ["id"]}, {"closeGroup": ["id"]}, "invoiceNumber",
        "termOfPayment", "row", "type", "externalRef", "systemGenerated", "taxTransactionType", "taxTransactionTypeId",
        "matched",
    ]),
    "ledger_vat_type": _offset("ledger/vatType", [
        "id", "name", "number", "displayName", "percentage", "deductionPercentage",
    ]),
    "product": _offset("product", [
        "id", "name", "number", "displayNumber", "description", "ean", "elNumber", "nrfNumber", "costExcludingVatCurrency",
        "expenses", "expensesInPercent", "costPrice", "profit", "profitInPercent", "priceExcludingVatCurrency",
        "priceIncludingVatCurrency", "isInactive", {"discountGroup": ["id"]}, {"productUnit": ["id"]}, "isStockItem",
        "stockOfGoods", {"vatType": ["id"]}, {"currency": ["id"]}, {"department": ["id"]}, {"account": ["id"]},
        "discountPrice", {"supplier": ["id"]}, "isDeletable", "hasSupplierProductConnected", "weight", "weightUnit",
        "volume", "volumeUnit", "hsnCode", {"image": ["id"]}, "markupListPercentage", "markupNetPercentage", "displayName",
        {"mainSupplierProduct": ["id"]},
    ]),
    "project": _offset("project", [
        "id", "name", "number", "displayName", "description", {"projectManager": ["id"]}, {"department": ["id"]},
        "startDate", "endDate", {"customer": ["id"]}, "isClosed", "isReadyForInvoicing", "isInternal", "isOffer",
        "isFixedPrice", {"projectCategory": ["id"]}, {"deliveryAddress": ["id"]}, "displayNameFormat", "reference",
        "externalAccountsNumber", "discountPercentage", {"vatType": ["id"]}, "fixedprice", "contributionMarginPercent",
        "numberOfSubProjects", "numberOfProjectParticipants", {"orderLines": ["id"]}, {"currency": ["id"]},
        "markUpOrderLines", "markUpFeesEarned", "isPriceCeiling", "priceCeilingAmount", {"projectHourlyRates": ["id"]},
        "forParticipantsOnly", {"participants": ["id"]}, {"contact": ["id"]}, {"attention": ["id"]}, "invoiceComment",
        {"invoicingPlan": ["id"]}, {"preliminaryInvoice": ["id"]}, "generalProjectActivitiesPerProjectOnly",
        {"projectActivities": ["id"]}, "hierarchyNameAndNumber", "invoiceDueDate", "invoiceDueDateType",
        "invoiceReceiverEmail", "accessType", "useProductNetPrice", "ignoreCompanyProductDiscountAgreement",
        "customerName", "hierarchyLevel", "projectManagerNameAndNumber", "totalInvoicedOnAccountAmountAbsoluteCurrency",
        "invoiceOnAccountVatHigh",
    ]),
    "project_lite": _offset("project", ["id", "name", "number", "isClosed"]),
    "supplier": _offset("supplier", [
        "id", "name", "organizationNumber", "supplierNumber", "customerNumber", "isSupplier", "isCustomer", "isInactive",
        "email", "invoiceEmail", "overdueNoticeEmail", "phoneNumber", "phoneNumberMobile", "description",
        "isPrivateIndividual", "showProducts", {"accountManager": ["id"]}, {"postalAddress": ["id"]},
        {"physicalAddress": ["id"]}, {"deliveryAddress": ["id"]}, {"category1": ["id"]}, {"category2": ["id"]},
        {"category3": ["id"]}, {"bankAccountPresentation": ["iban", "bban", "bic", {"country": ["id"]}, "provider"]},
        {"currency": ["id"]}, {"ledgerAccount": ["id"]}, "isWholesaler", "displayName", "locale", "website",
    ], changed_since=True),
    "supplier_lite": _offset("supplier", [
        "id", "name", "supplierNumber", "organizationNumber", "isInactive",
        {"postalAddress": ["addressLine1", "addressLine2", "postalCode", "city", {"country": ["isoAlpha2Code"]}]},
    ], changed_since=True),
    "supplier_bank_accounts_lite": _offset("supplier", [
        "id", "isInactive", {"bankAccountPresentation": ["iban", "bban", "provider"]},
    ], changed_since=True, explode=("bankAccountPresentation",)),
    "currency": _offset("currency", ["id", "code", "description", "factor", "displayName", "isDisabled"]),
    "balance_sheet": _windowed("balanceSheet", [
        "account", "balanceIn", "balanceChange", "balanceOut", "startDate", "endDate",
    ], sort_field="account.id"),
}
