"""Configuration of the web site-funnel model.

Below the FIXED VALUES marker: event allow-list, funnel steps, the
patient-portal test, the gates between steps, the booking attribution and
the ordered classification rules.  They must equal the reference model for
results to agree.  Rule conditions are SQL predicates over the lowercased
session columns (and ``ad_intention``); Spark evaluates them with
``F.expr`` and the DuckDB oracle renders the same text, so one table feeds
both.  Censored campaign ids of the original (``'xxxx'``, ``'******'``) are
kept as given: they are configuration and keep each rule's position.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference model; natural order)
# ---------------------------------------------------------------------------

# Events considered at all (the model filters events to this list first).
SITE_EVENT_ALLOW_LIST = [
    "lead_funnel_pageview__assessment",
    "lead_funnel_pageview__assessment_variants",
    "lead_funnel__assessment_v2",
    "lead_funnel_pageview_completed__assessment",
    "lead_funnel_submission_sa",
    "_assessment_contentful_completed_sa",
    "_assessment_pl_s",
    "_assessment_pl_ns",
    "marketing_lander_pages_start_2a_get_started_",
    "marketing_lander_pages_start_1a_am_i_a_candidate_",
    "jebbit_landing_pages_discovery_sa_click_first_page_of_sa",
    "marketing_lander_pages_start_thank_you_page",
    "jebbit_landing_pages_discovery_sa_submit_sa",
    "parent_teen_pageview_teens",
    "parent_teen_submit_teen_lead_form",
    "parent_teen_pageview_parents",
    "parent_teen_submit_parent_lead_form",
    "parent_teen_pageview_parent_video_confirmation",
    "kit_1st_page_new_w_w_o_promo",
    "kit_shipping_2_",
    "view_2nd_kit_page_shipping_11_14_2016__organic_traffic_marketing_emails",
    "kit_payment_3_",
    "view_3rd_kit_page_payment_11_14_2016__organic_traffic_marketing_emails",
    "ik_funnel_pageview_ik_ty",
    "view_1st_scanning_page_new_",
    "view_scanning_page_1st_page_",
    "successfully_scheduled_scan_appointment_1_2_",
    "completed_scan_appointment_booking_new_",
    "scan_order_funnel_shop_credit_card_page",
    "scans_view_shop_locations_page",
    "scans_view_shops_page",
    "shop_locations_page_view_unique_shop_page",
    "partner_network_view_appointment",
    "partner_network_appointment_confirmed",
    "contentful_scans_view_location_page",
    "contentful_scans_view_scan_checkout_thank_you",
    "site_funnels_combo_any_initial_scan_funnel_page",
    "scan_funnel_combo_any_scan_funnel_booking",
    "smp_web_view_web_csp",
    "sales_order_flow_order_your_saless_button",
    "view_1st_sales_checkout_page_11_9_2016_",
    "view_2nd_sales_checkout_page_11_9_2016_",
    "view_3rd_sales_checkout_page_11_9_2016_",
    "confirmed_purchase_of_saless_page_11_9_2016_",
    "insurance_funnel_combo_insurance_get_started",
    "insurance_funnel_combo_policyholder_or_dependent",
    "insurance_funnel_submit_full_insurance_form",
    "insurance_funnel_view_insurance_page",
    "insurance_funnel_step1_find_benefits",
    "insurance_funnel_step2_accountholder",
    "insurance_funnel_step3_customer",
    "insurance_funnel_step4_policy",
    "insurance_funnel_step5_finish",
    "bypass_funnel_click_get_started_banner",
    "bypass_funnel_submit_get_started_modal",
    "bypass_funnel_pageview_product_lander_from_bypass",
    "bypass_funnel_pageview_product_lander_bypass_no_zip",
    "order_kit_or_scan_incl_cc_page_12_10_17",
    "shopify_view_shop_site",
    "shopify_ca_view_shop_site",
    "shopify_view_checkout_page",
    "shopify_checkout_view_customer_info_page",
    "shopify_ca_checkout_view_customer_info_page",
    "shopify_checkout_view_shipping_page",
    "shopify_checkout_view_payment_page",
    "shopify_checkout_view_thank_you_page",
    "shopify_ca_checkout_view_thank_you_page",
    "shopify_view_product_page",
    "shopify_view_collection_page",
    "shopify_click_view_cart_count_wrapper",
    "shopify_click_view_cart_icon_wrapper",
    "shopify_click_add_to_cart",
    "shopify_checkout_view_order_page",
    "reschedule_funnel_pageview_patient_portal",
    "cloudsite_retainer_page_view",
    "cloudsite_retainer_confirmation",
    "view_any_care_page",
]

# Funnel steps: (flag, style, event names).  style "user" = the session's
# user was seen doing it (0 when the user id is NULL; the original counts
# distinct user ids), "any" = at least one such event row.
SITE_STEPS = [
    ("view_web_csp", "user", ["smp_web_view_web_csp"]),
    ("sa_view", "user", [
        "lead_funnel_pageview__assessment", "lead_funnel_pageview__assessment_variants",
        "lead_funnel__assessment_v2", "snapchat_landing_pages_total_snapchat_leads"]),
    ("sa_complete", "user", [
        "lead_funnel_pageview_completed__assessment", "lead_funnel_submission_sa",
        "_assessment_contentful_completed_sa", "_assessment_pl_s", "_assessment_pl_ns"]),
    ("lead_view", "user", [
        "marketing_lander_pages_start_2a_get_started_",
        "marketing_lander_pages_start_1a_am_i_a_candidate_",
        "jebbit_landing_pages_discovery_sa_click_first_page_of_sa"]),
    ("lead_complete", "user", [
        "marketing_lander_pages_start_thank_you_page",
        "jebbit_landing_pages_discovery_sa_submit_sa"]),
    ("sa_teen_view", "user", ["parent_teen_pageview_teens"]),
    ("sa_teen_complete", "user", ["parent_teen_submit_teen_lead_form"]),
    ("sa_teen_parent_view", "user", ["parent_teen_pageview_parents"]),
    ("sa_teen_parent_complete", "user", ["parent_teen_submit_parent_lead_form"]),
    ("PARENT_VIDEO_CONSULT_CTA", "user", ["parent_teen_click_video_consult_cta"]),
    ("parent_video_consult_complete", "user", ["parent_teen_pageview_parent_video_confirmation"]),
    ("retainer_page_view", "user", ["cloudsite_retainer_page_view"]),
    ("retainer_confirmation", "user", ["cloudsite_retainer_confirmation"]),
    ("ik_product_page", "any", ["kit_1st_page_new_w_w_o_promo"]),
    ("ik_shipping_page", "any", [
        "view_2nd_kit_page_shipping_11_14_2016__organic_traffic_marketing_emails"]),
    ("ik_payment_page", "any", [
        "kit_payment_3_", "view_3rd_kit_page_payment_11_14_2016__organic_traffic_marketing_emails"]),
    ("ik_thanks_page", "any", ["ik_funnel_pageview_ik_ty"]),
    ("any_scan_start_page", "any", ["site_funnels_combo_any_initial_scan_funnel_page"]),
    ("any_scan_complete_page", "any", ["scan_funnel_combo_any_scan_funnel_booking"]),
    ("scan_book_page", "any", [
        "view_1st_scanning_page_new_", "view_scanning_page_1st_page_",
        "partner_network_view_appointment"]),
    ("scan_complete_page", "any", [
        "successfully_scheduled_scan_appointment_1_2_", "completed_scan_appointment_booking_new_",
        "scan_order_funnel_shop_credit_card_page", "partner_network_appointment_confirmed",
        "contentful_scans_view_scan_checkout_thank_you"]),
    ("scan_locations_book_page", "any", [
        "scans_view_shop_locations_page", "scans_view_shops_page",
        "shop_locations_page_view_unique_shop_page"]),
    ("scan_single_location_page", "any", ["contentful_scans_view_location_page"]),
    ("sales_checkout_page", "any", ["view_1st_sales_checkout_page_11_9_2016_"]),
    ("sales_shipping_page", "any", ["view_2nd_sales_checkout_page_11_9_2016_"]),
    ("sales_payment_page", "any", ["view_3rd_sales_checkout_page_11_9_2016_"]),
    ("sales_purchase_page", "any", ["confirmed_purchase_of_saless_page_11_9_2016_"]),
    ("rcm_lead_page", "any", [
        "insurance_funnel_combo_insurance_get_started", "insurance_funnel_view_insurance_page"]),
    ("rcm_submit_info", "any", [
        "insurance_funnel_combo_policyholder_or_dependent", "insurance_funnel_step1_find_benefits"]),
    ("rcm_submit_form", "any", [
        "insurance_funnel_submit_full_insurance_form", "insurance_funnel_step5_finish"]),
    ("rcm_view_insurance_page", "any", ["insurance_funnel_view_insurance_page"]),
    ("rcm_benefits", "any", ["insurance_funnel_step1_find_benefits"]),
    ("rcm_accountholder", "any", ["insurance_funnel_step2_accountholder"]),
    ("rcm_customer", "any", ["insurance_funnel_step3_customer"]),
    ("rcm_policy", "any", ["insurance_funnel_step4_policy"]),
    ("rcm_finish", "any", ["insurance_funnel_step5_finish"]),
    ("bypass_banner_click", "any", ["bypass_funnel_click_get_started_banner"]),
    ("bypass_sa_submit_info", "any", ["bypass_funnel_submit_get_started_modal"]),
    ("bypass_sa_prod_page", "any", [
        "bypass_funnel_pageview_product_lander_from_bypass",
        "bypass_funnel_pageview_product_lander_bypass_no_zip"]),
    ("bypass_sa_order_page", "any", ["order_kit_or_scan_incl_cc_page_12_10_17"]),
    ("shopify_visit_shop", "any", ["shopify_view_shop_site", "shopify_ca_view_shop_site"]),
    ("shopify_view_collection", "any", ["shopify_view_collection_page"]),
    ("shopify_view_product", "any", ["shopify_view_product_page"]),
    ("shopify_view_cart", "any", [
        "shopify_click_view_cart_count_wrapper", "shopify_click_view_cart_icon_wrapper"]),
    ("shopify_add_to_cart", "any", ["shopify_click_add_to_cart"]),
    ("shopify_view_checkout", "any", ["shopify_view_checkout_page"]),
    ("shopify_checkout_customer_info", "any", [
        "shopify_checkout_view_customer_info_page", "shopify_ca_checkout_view_customer_info_page"]),
    ("shopify_checkout_shipping", "any", ["shopify_checkout_view_shipping_page"]),
    ("shopify_checkout_payment", "any", ["shopify_checkout_view_payment_page"]),
    ("shopify_checkout_thanks", "any", [
        "shopify_checkout_view_thank_you_page", "shopify_ca_checkout_view_thank_you_page"]),
    ("view_any_care_plus_page", "user", ["view_any_care_page"]),
    ("pn_appt_confirmed", "user", ["partner_network_appointment_confirmed"]),
]

# Patient portal: did the session reach the portal no later than its first
# evaluation order?  (flag name, portal event, evaluation events)
PORTAL = ("patient_portal", "reschedule_funnel_pageview_patient_portal", [
    "contentful_scans_view_scan_checkout_thank_you", "ik_funnel_pageview_ik_ty",
    "successfully_scheduled_scan_appointment_1_2_", "completed_scan_appointment_booking_new_",
    "scan_order_funnel_shop_credit_card_page", "order_kit_or_scan_incl_cc_page_12_10_17"])

# Ad intention of a campaign (looked up on the raw campaign text).
RETARGETING_CAMPAIGNS = [
    "dceml", "dcrtg", "igdcrtg", "ignycrtg", "nonop", "nonop516", "nonop616", "nyceml",
    "nycrtg", "rtg", "rtg-dsk", "rtg-nonop", "retargeting", "retargeting_new_pixel",
    "blog41916", "draymond-game-7", "retargeting_new", "dc-rtg", "nyc-rtg", "nycnonop",
    "dcnonop", "nshnonop", "pagevisit", "otpagevisit", "bfeb", "blackfriday", "cybermonday",
]

# Gates between steps.  Every gate reads the *ungated* step flags (the
# original computes them all in one SELECT whose aliases shadow inputs).
#   ("keep", x)             -> x
#   ("any", [a, b])         -> 1 if a = 1 or b = 1 else 0
#   ("all", [[a, b], ...])  -> 1 if any group has all members = 1 else 0
#   ("needs", req, x)       -> 0 if req = 0 else x   (NULL req passes x)
#   ("unless", blk, x)      -> 0 if blk = 1 else x
GATES = [
    ("view_web_csp", ("keep", "view_web_csp")),
    ("lead_view", ("any", ["sa_view", "lead_view"])),
    ("lead_complete", ("all", [["sa_view", "sa_complete"], ["lead_view", "lead_complete"]])),
    ("teen_sa_view", ("any", ["sa_teen_view"])),
    ("teen_sa_complete", ("all", [["sa_teen_view", "sa_teen_complete"]])),
    ("teen_sa_parent_view", ("any", ["sa_teen_parent_view"])),
    ("teen_sa_parent_complete", ("all", [["sa_teen_parent_view", "sa_teen_parent_complete"]])),
    ("PARENT_VIDEO_CONSULT_CTA", ("any", ["PARENT_VIDEO_CONSULT_CTA"])),
    ("parent_video_consult_complete",
     ("all", [["PARENT_VIDEO_CONSULT_CTA", "parent_video_consult_complete"]])),
    ("sa_view", ("keep", "sa_view")),
    ("sa_complete", ("needs", "sa_view", "sa_complete")),
    ("view_any_care_plus_page", ("keep", "view_any_care_plus_page")),
    ("pn_appt_confirmed", ("keep", "pn_appt_confirmed")),
    ("pn_appt_confirmed_for_care", ("needs", "view_any_care_plus_page", "pn_appt_confirmed")),
    ("retainer_page_view", ("keep", "retainer_page_view")),
    ("retainer_confirmation", ("needs", "retainer_page_view", "retainer_confirmation")),
    ("ik_product_page", ("unless", "scan_book_page", "ik_product_page")),
    ("ik_shipping_page", ("keep", "ik_shipping_page")),
    ("ik_payment_page", ("keep", "ik_payment_page")),
    ("ik_thanks_page_temp", ("needs", "ik_product_page", "ik_thanks_page")),
    ("scan_book_page", ("keep", "scan_book_page")),
    ("scan_locations_book_page", ("keep", "scan_locations_book_page")),
    ("scan_single_location_page", ("keep", "scan_single_location_page")),
    ("any_scan_start_page", ("keep", "any_scan_start_page")),
    ("any_scan_complete_page", ("keep", "any_scan_complete_page")),
    ("scan_complete_page_temp", ("needs", "scan_book_page", "scan_complete_page")),
    ("scan_locations_complete_page_temp", ("needs", "scan_locations_book_page", "scan_complete_page")),
    ("scan_single_location_complete_page_temp",
     ("needs", "scan_single_location_page", "scan_complete_page")),
    ("sales_checkout_page", ("keep", "sales_checkout_page")),
    ("sales_shipping_page", ("needs", "sales_checkout_page", "sales_shipping_page")),
    ("sales_payment_page", ("needs", "sales_shipping_page", "sales_payment_page")),
    ("sales_purchase_page", ("keep", "sales_purchase_page")),
    ("rcm_lead_page", ("keep", "rcm_lead_page")),
    ("rcm_submit_info", ("needs", "rcm_lead_page", "rcm_submit_info")),
    ("rcm_submit_form", ("needs", "rcm_submit_info", "rcm_submit_form")),
    ("rcm_view_insurance_page", ("keep", "rcm_view_insurance_page")),
    ("rcm_benefits", ("keep", "rcm_benefits")),
    ("rcm_accountholder", ("keep", "rcm_accountholder")),
    ("rcm_customer", ("keep", "rcm_customer")),
    ("rcm_policy", ("keep", "rcm_policy")),
    ("rcm_finish", ("keep", "rcm_finish")),
    ("bypass_banner_click", ("keep", "bypass_banner_click")),
    ("bypass_sa_prod_page", ("keep", "bypass_sa_prod_page")),
    ("bypass_sa_order_page_temp", ("needs", "bypass_sa_prod_page", "bypass_sa_order_page")),
    ("bypass_scan_complete_page_temp", ("needs", "bypass_sa_prod_page", "scan_complete_page")),
    ("bypass_kit_thanks_page", ("needs", "bypass_sa_prod_page", "ik_thanks_page")),
    ("shopify_visit_shop", ("keep", "shopify_visit_shop")),
    ("shopify_view_collection", ("keep", "shopify_view_collection")),
    ("shopify_view_product", ("keep", "shopify_view_product")),
    ("shopify_view_cart", ("keep", "shopify_view_cart")),
    ("shopify_add_to_cart", ("keep", "shopify_add_to_cart")),
    ("shopify_checkout_customer_info", ("keep", "shopify_checkout_customer_info")),
    ("shopify_checkout_shipping", ("keep", "shopify_checkout_shipping")),
    ("shopify_checkout_payment", ("keep", "shopify_checkout_payment")),
    ("shopify_checkout_thanks", ("keep", "shopify_checkout_thanks")),
    ("patient_portal", ("keep", "patient_portal")),
]

# Exclusive booking attribution over the gated flags.  Each output is 1
# when every listed (flag, value) pair holds; "or" entries are alternatives
# tried in order, and a name in ATTRIBUTION may be read by a later entry.
ATTRIBUTION = [
    ("scan_complete_page", [[("scan_complete_page_temp", 1),
                             ("scan_single_location_complete_page_temp", 0),
                             ("scan_locations_complete_page_temp", 0)]]),
    ("scan_locations_complete_page", [[("scan_complete_page_temp", 0),
                                       ("scan_single_location_complete_page_temp", 0),
                                       ("scan_locations_complete_page_temp", 1)]]),
    ("single_scan_location_complete_page", [[("scan_complete_page_temp", 0),
                                             ("scan_single_location_complete_page_temp", 1),
                                             ("scan_locations_complete_page_temp", 0)]]),
    ("scan_location_complete_after_checkout_page", [[("scan_single_location_complete_page_temp", 1),
                                                     ("scan_complete_page_temp", 1),
                                                     ("scan_locations_complete_page_temp", 0)]]),
    ("scan_location_complete_after_shops_page", [[("scan_single_location_complete_page_temp", 1),
                                                  ("scan_locations_complete_page_temp", 1),
                                                  ("scan_complete_page_temp", 0)]]),
    ("scan_location_complete_after_web_csp", [[("any_scan_complete_page", 1), ("view_web_csp", 1)]]),
    ("bypass_sa_order_page", [[("scan_locations_complete_page_temp", 0),
                               ("bypass_scan_complete_page_temp", 1)]]),
    ("non_by_pass_scan_completion", [[("bypass_scan_complete_page_temp", 0),
                                      ("scan_complete_page_temp", 1)],
                                     [("scan_complete_page", 1)],
                                     [("scan_locations_complete_page", 1)]]),
    ("ik_thanks_page", [[("bypass_sa_order_page_temp", 0), ("ik_thanks_page_temp", 1)]]),
]

# Ordered classification rules: first match wins.  Predicates read the
# lowercased session columns utm_source, utm_campaign, utm_medium,
# utm_term, referrer, landing_page, browser, platform and ad_intention.
BROWSER_RULES = [
    ("Firefox", "browser LIKE '%firefox%'"),
    ("Chrome", "browser LIKE '%chrome%'"),
    ("Internet Explorer", "browser LIKE 'ie%'"),
    ("Internet Explorer", "browser LIKE '%internet explorer%'"),
    ("Safari", "browser LIKE '%safari%'"),
    ("Pinterest App", "browser LIKE '%pinterest%'"),
    ("Facebook App", "browser LIKE '%facebook%'"),
]
BROWSER_DEFAULT = "Other"

CHANNEL_RULES = [
    ("Snapchat", "utm_source = 'snapchat'"),
    ("Google Paid Search - Conquesting", "utm_source = 'google' AND utm_campaign LIKE '%competitors%'"),
    ("Google Paid Search - Branded", "utm_source = 'google' AND utm_campaign LIKE '%branded%'"),
    ("Google Paid Search - Non-Branded", "utm_source = 'google' AND utm_campaign NOT LIKE '%branded%'"),
    ("Google Paid Search - Non-Branded",
     "utm_source = 'google' AND utm_campaign IS NULL AND utm_medium = 'cpc'"),
    ("Bing Paid Search - Conquesting", "utm_source = 'bing' AND utm_campaign LIKE '%competitors%'"),
    ("Bing Paid Search - Branded", "utm_source = 'bing' AND utm_campaign LIKE '%branded%'"),
    ("Bing Paid Search - Non-Branded", "utm_source = 'bing' AND utm_campaign NOT LIKE '%branded%'"),
    ("Bing Paid Search - Non-Branded",
     "utm_source = 'bing' AND utm_campaign IS NULL AND utm_medium = 'cpc'"),
    ("Yahoo Paid Search - Conquesting", "utm_source = 'yahoo' AND utm_campaign LIKE '%competitors%'"),
    ("Yahoo Paid Search - Branded", "utm_source = 'yahoo' AND utm_campaign LIKE '%branded%'"),
    ("Yahoo Paid Search - Non-Branded", "utm_source = 'yahoo' AND utm_medium = 'cpc'"),
    ("Yahoo - Native",
     "utm_source = 'yahoo' AND (utm_medium = 'native' OR utm_medium = 'nativeca')"),
    ("Yahoo - Prospecting",
     "utm_source = 'yahoo' AND (utm_campaign LIKE '%prsp%' OR utm_medium LIKE '%prsp%')"),
    ("Yahoo - Retargeting",
     "utm_source = 'yahoo' AND (utm_campaign LIKE '%retargeting%' OR utm_medium LIKE '%rtgg%')"),
    ("Pandora", "utm_source = 'pandora'"),
    ("DataXu - Retargeting", "utm_source = 'dataxu' AND utm_campaign LIKE '%rtg%'"),
    ("DataXu", "utm_source = 'dataxu' OR utm_source = 'dataxuca' OR utm_source = 'dataxuau'"),
    ("theSkimm", "utm_source = 'theskimm'"),
    ("Centro", "utm_source = 'centro'"),
    ("E-mail", "utm_source IN ('trigger', 'adhoc', 'silverpopmailing', 'email')"),
    ("E-mail", "utm_medium = 'email'"),
    ("Groupon", "utm_source = 'groupon'"),
    ("Groupon", "utm_campaign LIKE '%groupon%'"),
    ("Taboola - Retargeting",
     "utm_source = 'taboola' AND (ad_intention = 'retargeting' OR utm_medium = 'rtgg')"),
    ("Taboola - Prospecting",
     "utm_source = 'taboola' AND (ad_intention = 'prospecting' OR utm_medium = 'prsp')"),
    ("Taboola - Unknown", "utm_source = 'taboola'"),
    ("Outbrain - Retargeting",
     "utm_source = 'outbrain' AND (ad_intention = 'retargeting' OR utm_medium = 'rtgg')"),
    ("Outbrain - Prospecting",
     "utm_source = 'outbrain' AND (ad_intention = 'prospecting' OR utm_medium = 'prsp')"),
    ("Outbrain - Unknown", "utm_source = 'outbrain'"),
    ("Facebook - Influencers",
     "utm_source = 'facebook' AND (utm_campaign LIKE '%infl%'"
     " OR (utm_campaign IN ('xxxx', 'YYY') AND utm_term IN ('XXX', 'YYY'))"
     " OR utm_campaign IN ('******'))"),
    ("Facebook - Prospecting - Awareness",
     "utm_source = 'facebook' AND utm_campaign IN ('6115796720030', 'geo-video-hf-an', '6127401037230')"),
    ("Facebook - Prospecting - Leads",
     "utm_source = 'facebook' AND (utm_campaign IN ('6115789297830', '6109424936030')"
     " OR (utm_campaign = '6117747670830' AND utm_term = '6117747670230')"
     " OR (utm_campaign = '6115789297830' AND utm_term = '6115789298430'))"),
    ("Facebook - Prospecting - Sales", "utm_source = 'facebook' AND utm_campaign IN ('******')"),
    ("Facebook - Prospecting - Sales", "utm_source = 'facebook' AND utm_campaign IN ('******')"),
    ("Facebook - Prospecting - Sales",
     "utm_source = 'facebook' AND utm_campaign LIKE '%campaign.id}%'"
     " AND utm_term LIKE '%adset.id%' AND utm_medium = 'paidsocial'"),
    ("Facebook - Prospecting - Influencers",
     "utm_source = 'facebook' AND utm_campaign LIKE '%campaign.id}%'"
     " AND utm_term LIKE '%adset.id%' AND utm_medium = 'social'"),
    ("Facebook - Retargeting",
     "(utm_source = 'facebook' AND utm_campaign = '******')"
     " OR (utm_source = 'facebook' AND utm_campaign IN ('******', '******')"
     " AND utm_term IN ('******', '******'))"),
    ("Facebook - Retargeting",
     "utm_source = 'facebook' AND (ad_intention = 'retargeting' OR utm_medium = 'rtgg'"
     " OR utm_campaign LIKE '%retargeting%')"),
    ("Facebook - Prospecting - Sales",
     "utm_source = 'facebook' AND (ad_intention = 'prospecting' OR utm_medium = 'prsp')"),
    ("Facebook - Social", "utm_source = 'facebook' AND utm_medium = 'social'"),
    ("Facebook - Unknown", "utm_source = 'facebook'"),
    ("Pinterest - Retargeting - Leads",
     "utm_source = 'pinterest' AND utm_campaign IN ('******', '******')"),
    ("Pinterest - Retargeting - Sales", "utm_source = 'pinterest' AND utm_campaign IN ('******')"),
    ("Pinterest - Retargeting",
     "utm_source = 'pinterest' AND (ad_intention = 'retargeting' OR utm_medium = 'rtgg'"
     " OR utm_campaign LIKE '%retargeting%' OR utm_campaign LIKE '%rtg%' OR utm_medium LIKE '%rtg%')"),
    ("Pinterest - Prospecting",
     "utm_source = 'pinterest' AND (ad_intention = 'prospecting' OR utm_medium LIKE '%prsp%'"
     " OR utm_campaign LIKE '%prsp%')"),
    ("Pinterest - Prospecting - Sales",
     "utm_source = 'pinterest' AND utm_campaign IN ('******', '******', '******', '******', '******')"),
    ("Pinterest - Prospecting - Leads",
     "utm_source = 'pinterest' AND utm_campaign IN ('******', '******')"),
    ("Pinterest - Prospecting - Awareness",
     "utm_source = 'pinterest' AND utm_campaign IN ('******', '******')"),
    ("Pinterest - Bonus Media - Awareness",
     "utm_source = 'pinterest' AND utm_campaign IN ('******', '******')"),
    ("Pinterest - Unknown", "utm_source = 'pinterest'"),
    ("Pinterest - Unknown", "utm_medium = 'paidsocialca'"),
    ("Match Media Group - Tinder", "utm_source = 'tinder'"),
    ("Yellow Hammer", "utm_source = 'yh'"),
    ("Affiliates", "utm_source = 'affiliates'"),
    ("Instagram - Retargeting",
     "utm_source = 'instagram' AND (ad_intention = 'retargeting' OR utm_medium = 'rtgg'"
     " OR utm_campaign LIKE '%retargeting%')"),
    ("Instagram - Prospecting",
     "utm_source = 'instagram' AND (ad_intention = 'prospecting' OR utm_medium = 'prsp')"),
    ("Instagram - Unknown", "utm_source = 'instagram'"),
    ("Outbrain - Retargeting",
     "referrer LIKE '%outbrain%' AND (ad_intention = 'retargeting' OR utm_medium = 'rtgg')"),
    ("Outbrain - Prospecting",
     "referrer LIKE '%outbrain%' AND (ad_intention = 'prospecting' OR utm_medium = 'prsp')"),
    ("Outbrain - Unknown", "referrer LIKE '%outbrain%'"),
    ("Taboola - Retargeting",
     "referrer LIKE '%taboola%' AND (ad_intention = 'retargeting' OR utm_medium = 'rtgg')"),
    ("Taboola - Prospecting",
     "referrer LIKE '%taboola%' AND (ad_intention = 'prospecting' OR utm_medium = 'prsp')"),
    ("Taboola - Unknown", "referrer LIKE '%taboola%'"),
    ("Pandora", "utm_source IS NULL AND referrer LIKE '%pandora%'"),
    ("Groupon", "utm_source IS NULL AND referrer LIKE '%groupon%'"),
    ("Google Search - Organic", "utm_source IS NULL AND referrer LIKE '%google%'"),
    ("Bing Search - Organic", "utm_source IS NULL AND referrer LIKE '%bing%'"),
    ("Facebook - Retargeting",
     "referrer LIKE '%facebook%' AND (ad_intention = 'retargeting' OR utm_medium = 'rtgg'"
     " OR utm_campaign LIKE '%retargeting%')"),
    ("Facebook - Prospecting - Sales",
     "referrer LIKE '%facebook%' AND (ad_intention = 'prospecting' OR utm_medium = 'prsp')"),
    ("Facebook - Unknown", "referrer LIKE '%facebook%'"),
    ("Pinterest - Retargeting",
     "referrer LIKE '%pinterest%' AND (ad_intention = 'retargeting' OR utm_medium = 'rtgg'"
     " OR utm_campaign LIKE '%retargeting%')"),
    ("Pinterest - Prospecting",
     "referrer LIKE '%pinterest%' AND (ad_intention = 'prospecting' OR utm_medium = 'prsp')"),
    ("Pinterest - Unknown", "referrer LIKE '%pinterest%'"),
    ("Instagram - Retargeting",
     "referrer LIKE '%instagram%' AND (ad_intention = 'retargeting' OR utm_medium = 'rtgg'"
     " OR utm_campaign LIKE '%retargeting%')"),
    ("Instagram - Prospecting",
     "referrer LIKE '%instagram%' AND (ad_intention = 'prospecting' OR utm_medium = 'prsp')"),
    ("Instagram - Unknown", "referrer LIKE '%instagram%'"),
    ("E-mail", "referrer LIKE '%utm_medium=email%'"),
    ("E-mail", "referrer LIKE '%3Demail%'"),
    ("Direct Load - Homepage",
     "utm_source IS NULL AND utm_campaign IS NULL AND referrer IS NULL AND landing_page = 'website.com/'"),
    ("Direct Load - Homepage",
     "utm_source IS NULL AND utm_campaign IS NULL AND referrer = 'https://website.com/'"
     " AND landing_page = 'website.com/'"),
    ("Direct Load - Homepage",
     "utm_source IS NULL AND utm_campaign IS NULL AND referrer IS NULL AND landing_page = 'website.ca/'"),
    ("Direct Load - Homepage",
     "utm_source IS NULL AND utm_campaign IS NULL AND referrer = 'https://website.com/.ca/'"
     " AND landing_page = 'website.ca/'"),
    ("Direct Load - Non-Homepage",
     "utm_source IS NULL AND utm_campaign IS NULL AND referrer IS NULL"
     " AND landing_page LIKE 'website.com/%'"),
    ("Prior SDC Visitor After Inactivity",
     "utm_source IS NULL AND utm_campaign IS NULL AND referrer LIKE '%website.com%'"
     " AND landing_page LIKE 'website.com/%'"),
    ("Direct Load - Non-Homepage",
     "utm_source IS NULL AND utm_campaign IS NULL AND referrer IS NULL"
     " AND landing_page LIKE 'website.ca/%'"),
    ("Prior SDC Visitor After Inactivity",
     "utm_source IS NULL AND utm_campaign IS NULL AND referrer LIKE '%website.ca%'"
     " AND landing_page LIKE 'website.ca/%'"),
]
CHANNEL_DEFAULT = "Other"

EMAIL_STREAM_RULES = [
    ("Broadcast Emails Scan Leads", "utm_medium = 'email' AND utm_campaign LIKE 'brdcst_slead%'"),
    ("Broadcast Emails Kit Leads", "utm_medium = 'email' AND utm_campaign LIKE 'brdcst_klead%'"),
    ("Broadcast Emails with Auto", "utm_medium = 'email' AND utm_campaign LIKE '%brdcst%'"),
    ("Kit Lead Stream", "utm_medium = 'email' AND utm_campaign LIKE '%wbk%'"),
    ("Scan Lead Stream", "utm_medium = 'email' AND utm_campaign LIKE '%wbs%'"),
    ("Kit/Scan Lead Stream", "utm_medium = 'email' AND utm_campaign LIKE '%wb%'"),
    ("sales Lead Stream", "utm_medium = 'email' AND utm_campaign LIKE '%rb%'"),
    ("Appointment Stream", "utm_medium = 'email' AND utm_campaign LIKE '%gb%'"),
    ("Kit Return Stream", "utm_medium = 'email' AND utm_campaign LIKE '%pb%'"),
    ("In-Treatment Stream", "utm_medium = 'email' AND utm_campaign LIKE '%bb%'"),
    ("Kit/Scan Lead Stream", "utm_medium = 'email' AND utm_campaign LIKE '%kslead%'"),
    ("Kit Lead Stream", "utm_medium = 'email' AND utm_campaign LIKE '%klead%'"),
    ("Scan Lead Stream", "utm_medium = 'email' AND utm_campaign LIKE '%slead%'"),
    ("Kit Return Stream", "utm_medium = 'email' AND utm_campaign LIKE '%kitst%'"),
    ("Appointment Stream", "utm_medium = 'email' AND utm_campaign LIKE '%scanst%'"),
    ("sales Lead Stream", "utm_medium = 'email' AND utm_campaign LIKE '%arlead%'"),
    ("Pre-Auth Stream", "utm_medium = 'email' AND utm_campaign LIKE '%pauthst%'"),
    ("In-Treatment Stream", "utm_medium = 'email' AND utm_campaign LIKE '%intreat%'"),
    ("Post-Treatment Stream", "utm_medium = 'email' AND utm_campaign LIKE '%posttr%'"),
    ("Insurance Stream", "utm_medium = 'email' AND utm_campaign LIKE '%insst%'"),
    ("Align Lead Stream", "utm_medium = 'email' AND utm_campaign LIKE '%ialead%'"),
    ("Abandon Cart Stream", "utm_medium = 'email' AND utm_campaign LIKE '%abcrt%'"),
    ("Transactional", "utm_medium = 'email' AND utm_campaign LIKE '%trig%'"),
    ("Other", "referrer LIKE '%utm_medium=email%'"),
    ("Other", "referrer LIKE '%3demail%'"),
    ("Other", "utm_source IN ('trigger', 'adhoc', 'silverpopmailing')"),
    ("Other", "utm_medium = 'email'"),
]
EMAIL_STREAM_DEFAULT = None

PLATFORM_RULES = [
    ("Android", "platform LIKE '%android%'"),
    ("Windows", "platform LIKE '%windows%'"),
    ("Chrome OS", "platform LIKE '%chrome os%'"),
    ("iOS", "platform LIKE '%ios%'"),
    ("Mac OS", "platform LIKE '%mac os%'"),
]
PLATFORM_DEFAULT = "Other"

# Sessions in this landing-page group are app sessions and are skipped.
APP_SESSIONS_GROUP = "App sessions"

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

# Session columns lowercased before classification, in the model's order.
LOWERED_SESSION_COLUMNS = [
    "device_type", "referrer", "landing_page", "utm_source", "utm_campaign", "utm_medium",
    "utm_term", "utm_primary_rollup", "utm_primary_rollup_split", "utm_digital_rollup",
    "utm_platform", "browser", "platform",
]

# Output dimension columns of the site model, before the step flags.
SITE_DIMENSIONS = [
    "DATE", "user_id", "distinct_session_id", "session_id", "device", "channel",
    "utm_primary_rollup", "utm_primary_rollup_split", "utm_medium", "utm_source",
    "utm_platform", "utm_digital_rollup", "browser", "email_stream", "platform",
    "business_entity", "business_entity_language", "first_session_date",
]


def site_vocabulary() -> list[str]:
    """Event names used to relabel raw driver events for the site model.

    The allow-list, the two step events missing from it (they must never
    fire) and one unrelated page view, sorted for a stable relabelling.
    """
    names = set(SITE_EVENT_ALLOW_LIST)
    for _, _, events in SITE_STEPS:
        names |= set(events)
    names |= {PORTAL[1], *PORTAL[2], "generic_page_view"}
    return sorted(names)
