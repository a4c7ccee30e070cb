"""Typed-view specs: which payload fields each landing table carries, and their rules.

Words read ``key[:rule][=output]``; a missing rule is ``text``, a missing output
is the lower-case key after its last dot. ``<trade>`` and ``<credit>`` stand for
the source system's own product prefixes, given by the caller.
"""

from __future__ import annotations

from collections.abc import Mapping

from forecourt.functions.payload import ViewSpec, parse_fields

_BILLING = ("id", "updateddate")
_TIMED = ("id", "created_at", "updated_at")
_CREATED = ("id", "created_at")

# Payload fields of each source, in source order.
# view -> (envelope columns, key prefix, fields)
_FIELDS = {
    "v_account": (_BILLING, "Account", """
        Mrr:numeric Name Batch CrmId Notes VAT Status AutoPay:boolean Balance:numeric Currency ParentId
        is_deleted:boolean CreatedById CreatedDate:ts_offset PaymentTerm UpdatedById BillCycleDay:int SalesRepName
        AccountNumber CreditBalance:numeric SequenceSetId=sequencesettid PaymentGateway TaxCompanyCode
        LastInvoiceDate:ts_local TaxExemptStatus AllowInvoiceEdit:boolean BcdSettingOption UnappliedBalance:numeric
        InvoiceTemplateId PurchaseOrderNumber TotalInvoiceBalance:numeric TaxExemptDescription
        TotalDebitMemoBalance:numeric CommunicationProfileId CustomerServiceRepName TaxExemptCertificateID
        TaxExemptEffectiveDate:ts_offset TaxExemptEntityUseCode AdditionalEmailAddresses TaxExemptCertificateType
        internalAccountNumber__c:int InvoiceDeliveryPrefsEmail:boolean InvoiceDeliveryPrefsPrint:boolean
        UnappliedCreditMemoAmount:numeric TaxExemptIssuingJurisdiction
        contactLanguagePreference__c=contactlaanguagepreference__c"""),
    "v_invoiceitem": (_BILLING, "InvoiceItem", """
        SKU UOM Balance:numeric TaxCode TaxMode Quantity:int TaxAmount:numeric UnitPrice:numeric ChargeDate:ts_offset
        ChargeName is_deleted:boolean CreatedById CreatedDate:ts_offset UpdatedById ChargeAmount:numeric
        AccountingCode ProcessingType:int ServiceEndDate:ts_local SubscriptionId RevRecStartDate:ts_local
        TaxExemptAmount:numeric ServiceStartDate:ts_local AppliedToInvoiceItemId Invoice.Id=invoiceid"""),
    "v_invoice": (_BILLING, "Invoice", """
        Amount:numeric Source Status AutoPay:boolean Balance:numeric DueDate:ts_local Comments PostedBy
        Reversed:boolean SourceId TaxAmount:numeric PostedDate:ts_offset TargetDate:ts_local is_deleted:boolean
        CreatedById CreatedDate:ts_offset InvoiceDate:ts_local UpdatedById RefundAmount:numeric IncludesUsage:boolean
        InvoiceNumber PaymentAmount:numeric IncludesOneTime:boolean TaxExemptAmount:numeric AdjustmentAmount:numeric
        AmountWithoutTax:numeric IncludesRecurring:boolean LastEmailSentDate:ts_offset legacyInvoiceNumber__c
        TransferredToAccounting:boolean CreditBalanceAdjustmentAmount:numeric"""),
    "v_subscription": (_BILLING, "Subscription", """
        Name Notes Status Version:int TermType AutoRenew:boolean OriginalId is_deleted:boolean CreatedById
        CreatedDate:ts_offset CurrentTerm:int InitialTerm:int RenewalTerm:int TermEndDate:ts_local UpdatedById
        CancelledDate:ts_local QuoteType__QT TermStartDate:ts_local InvoiceOwnerId RenewalSetting QuoteNumber__QT
        CreatorAccountId IsInvoiceSeparate:boolean CpqBundleJsonId__QT OpportunityName__QT
        OriginalCreatedDate:ts_offset SubscriptionEndDate:ts_local ContractEffectiveDate:ts_local
        CreatorInvoiceOwnerId CurrentTermPeriodType InitialTermPeriodType QuoteBusinessType__QT RenewalTermPeriodType
        ServiceActivationDate:ts_local SubscriptionStartDate:ts_local ContractAcceptanceDate:ts_local
        PreviousSubscriptionId OpportunityCloseDate__QT=opportunitycloseddate__qt"""),
    "v_creditmemo": (_BILLING, "CreditMemo", """
        Source Status Balance:numeric Comments MemoDate:ts_local PostedOn:ts_offset SourceId TaxAmount:numeric
        MemoNumber PostedById ReasonCode TargetDate:ts_local is_deleted:boolean CancelledOn:ts_offset CreatedById
        CreatedDate:ts_offset TotalAmount:numeric UpdatedById RefundAmount:numeric AppliedAmount:numeric CancelledById
        DiscountAmount:numeric ExchangeRateDate:ts_local TotalTaxExemptAmount:numeric TotalAmountWithoutTax:numeric
        TransferredToAccounting:boolean=transeferredtoaccounting legacyCreditMemoNumber__c"""),
    "v_order": (_BILLING, "Order", """
        OrderDate:ts_local is_deleted:boolean CreatedById CreatedDate:ts_offset Description OrderNumber UpdatedById
        Account.Id=accountid"""),
    "v_contact": (_BILLING, "Contact", """
        Fax City State County Country Address1 Address2 LastName NickName AccountId FirstName HomePhone TaxRegion
        WorkEmail WorkPhone OtherPhone PostalCode:strip_spaces is_deleted:boolean CreatedById CreatedDate:ts_offset
        Description MobilePhone UpdatedById PersonalEmail OtherPhoneType"""),
    "v_master_businesses": (_TIMED, "", """
        name website_url phone_number address_line_1 address_line_2=address_line2 city postal_code:strip_spaces
        country province subscriptions category crm crm_id belongs_to_dealership_group:int contact_language_pref
        parent_business_id:uuid zuora_account_id account_number partner_name route_one_integration_id
        spincar_dealer_id"""),
    "v_marketplace_leads": (_TIMED, "", """
        status customer_first_name customer_last_name customer_email customer_phone customer_language
        customer_mobile_phone customer_payload:json customer_address_line_1 customer_address_line_2 customer_city
        customer_postal_code:strip_spaces customer_country customer_province trade_high_value:cents
        trade_low_value:cents trade_deductions trade_customer_referral_url trade_vehicle_year:int trade_vehicle_make
        trade_vehicle_model trade_vehicle_style trade_vehicle_trim trade_vehicle_mileage:double trade_vehicle_vin
        insurance_quote_id:uuid insurance_referrer_url insurance_quote_payload:json insurance_purchase_price:cents
        insurance_vehicle_year:int insurance_vehicle_make insurance_vehicle_model insurance_vehicle_trim
        insurance_vehicle_style insurance_vehicle_mileage:double insurance_vehicle_vin customer_birthdate:ts_plain
        customer_tracking_id credit_rating:int credit_dealertrack_sent_at:ts_plain source_url
        credit_vehicle_price:cents credit_trade_in_value:cents credit_down_payment:double credit_sales_tax:double
        credit_interest_rate:double credit_loan_amount:double language_code integration_settings_id:uuid
        credit_creditor_name credit_payload:json trade_low_list:cents trade_high_list:cents trade_list_count:int
        trade_aged_discount:cents trade_reconditioning:cents trade_advertising:cents trade_overhead:cents
        trade_dealer_profit:cents trade_in_source route_list:json experiment:json credit_payment_frequency:int
        credit_trade_in_owing:double credit_payment_amount:double credit_term_in_months:int
        credit_regional_rating:int ecom_reserved:int testdrive_requested_date:ts_plain
        testdrive_time_of_day_preference testdrive_language testdrive_gender_preference
        testdrive_technology_interests:json testdrive_route_name testdrive_beverage testdrive_comments
        oem_of_interest billing_key spincar_lead_report_url is_insurance:int is_trade:int is_credit_partial:int
        is_credit_verified:int is_credit_finance:int is_ecom:int is_spotlight:int device is_credit_regional:int
        is_test_drive:int subType=sub_type is_accident_check:int"""),
    "v_sales_data": ((), "", """
        Cost:double MSRP:double Term:int BankName DealType SaleType BackGross:double CashPrice:double
        EntryDate:date_us Language ListPrice:double LeaseTerm:int TrimLevel ACDealerID DealNumber DealStatus
        FrontGross:double StatusDate:date_us VehicleVIN CoBuyerCell CoBuyerCity CoBuyerName CustomerZip
        DownPayment:double VehicleMake VehicleType VehicleYear:int CoBuyerEmail CoBuyerState ContractDate:date_us
        CustomerCity CustomerName DealBookDate:date_us RealBookDate:date_us VehicleModel CustomerEmail CustomerState
        InvoiceAmount:double RetailPayment:double TradeIn_1_VIN TradeIn_2_VIN AccountingDate:date_us
        AmountFinanced:double CoBuyerAddress ClientDealerID CoBuyerCountry CoBuyerCustNum CustomerCounty
        CustomerNumber NetTradeAmount:double TradeIn_1_Make TradeIn_1_Year:int TradeIn_2_Make TradeIn_2_Year:int
        VehicleMileage:int CoBuyerLastName CustomerAddress GrossProfitSale:double Salesman_1_Name
        TradeIn_1_Gross:double TradeIn_1_Model TradeIn_2_Gross:double TradeIn_2_Model CoBuyerFirstName
        CoBuyerHomePhone CoBuyerWorkPhone CustomerLastName SalesManagerName TradeIn_1_Payoff:double
        TradeIn_2_Payoff:double CustomerBirthDate:date_us CustomerCellPhone CustomerFirstName CustomerHomePhone
        CustomerWorkPhone"""),
    "v_accident_check_reports": (_CREATED, "", """
        vin status batch_id expired_on:ts_plain data_source:int is_archived:int vin_pattern disclosure_id:int
        accident_reported master_business_id accident_damage_level accident_repair_amount:int"""),
    "v_trade_leads": (_CREATED, "", """
        type:int status:int payload:json customer_ip vehicle_vin vehicle_make vehicle_trim vehicle_year:int
        customer_name vehicle_model vehicle_style vehicle_prices:unescape_json vehicle_mileage:double
        <trade>_report_id:uuid vehicle_deductions:unescape_json customer_postal_code:strip_spaces
        customer_phone_number customer_referrer_url customer_email_address <trade>_business_profile_id:uuid"""),
    "v_trade_businesses": (_TIMED, "", """
        city name status:int crm_type:int postal_code:strip_spaces website_url country_code phone_number:json
        province_code address_line_1 address_line_2 crm_account_id master_business_id:uuid stripe_customer_id"""),
    "v_trade_business_profiles": (_CREATED, "", """
        type:int gtm_id status:int api_key:uuid language external_id integration_name business_crm_type
        <credit>_integration:int crm_recipient_emails:json <trade>_business_id:uuid lead_recipient_emails:json
        phone_number_verification:int regional_price_adjustment:double"""),
    "v_credit_leads": (_TIMED, "", """
        city country province birthdate:ts_day_text last_name lead_type:int report_id:uuid first_name billing_key
        lead_status:int postal_code:strip_spaces tracking_id meta_monthly:double phone_number:json credit_rating
        email_address address_line_1 address_line_2 financial_form meta_sales_tax:double conversation_id
        meta_source_url meta_loan_amount:double route_one_result routeone_sent_at meta_down_payment:double
        meta_loan_balance:double meta_interest_rate:double meta_loan_duration:int meta_vehicle_price:double
        dealertrack_sent_at:ts_plain meta_trade_in_value:double financial_form_stored_at:ts_plain"""),
    "v_credit_businesses": (_TIMED, "", """
        city name status:int country crm_type:int province postal_code:strip_spaces website_url phone_number:json
        address_line_1 address_line_2 crm_account_id master_business_id:uuid stripe_customer_id"""),
    "v_credit_business_profiles": (_TIMED, "", """
        crm:int type:int banks:json status:int api_key:uuid buttons:json language live_date:ts_plain fax_number
        business_id:uuid external_id route_one_key dealertrack_id finance_emails:json interest_rates:json
        integration_name crm_recipient_emails:json lead_recipient_emails:json dealertrack_confirm_id"""),
    "v_credit_reports": (_TIMED, "", """
        city status:int country language province verified:int birthdate:ts_plain last_name first_name
        profile_id:uuid source_url postal_code:strip_spaces tracking_id phone_number:json credit_rating:int
        email_address address_line_1 address_line_2 <trade>_report_id:uuid"""),
    "v_insurance_leads": (_TIMED, "", """
        vin city make trim year:int email model phone style country mileage:double payload:json language province
        quote_id:uuid last_name lead_type first_name profile_id:uuid lead_status postal_code:strip_spaces mobile_phone
        referrer_url quote_payload:json address_line_1 address_line_2 purchase_price:double"""),
    "v_insurance_business_profiles": (("id",), "", """
        type gtm_id status api_key crm_type language live_date:ts_plain business_id:uuid external_id
        crm_recipient_emails:json lead_recipient_emails:json requires_mobile_verification:int"""),
}

VIEW_NAMES = tuple(_FIELDS)

# Fixed value: a dealer id that was renamed in the sales feed.
SALES_REMAPS = {
    "clientdealerid": {"d6a8da09-ed94-4828-8ba4-4b35e99c4ab0": "bfd98837-6f44-46c2-a465-4425b5a4c67a"},
}


def view_spec(name: str, products: Mapping[str, str] | None = None) -> ViewSpec:
    """Spec of one typed view; ``products`` fills the ``<trade>`` / ``<credit>`` prefixes."""
    envelope, prefix, text = _FIELDS[name]
    for slot in ("trade", "credit"):
        text = text.replace(f"<{slot}>", (products or {}).get(slot, slot))
    return ViewSpec(envelope, parse_fields(text, prefix))
