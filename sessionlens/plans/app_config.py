"""Configuration of the app-funnel session model (milestones per session).

Everything below the FIXED VALUES marker is data that must equal the
reference model for results to agree: event names and the milestone each
one feeds, in the model's own column order.  Operators never hard-code
event names; they receive these structures as arguments.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference model; natural order)
# ---------------------------------------------------------------------------

# Sessions are kept only if one of their events is a "view" event.
APP_VIEW_EVENTS = [
    "general_app_ios_view_welcome_screen",
    "general_app_ios_view_waiting_room",
    "general_app_ios_view_scan_live_lobby",
    "general_app_ios_view_onboarding",
    "general_app_ios_view_custom_smile_plan_viewer",
    "first_start_smile_maker_video",
    "general_app_ios_nsdk_view_contact_information",
    "general_app_ios_nsdk_view_learn_more",
    "general_app_ios_nsdk_view_welcome_screen",
    "general_app_ios_nsdk_view_waiting_room",
    "general_app_ios_nsdk_view_phonecapture",
    "general_app_ios_nsdk_view_scan_live_lobby",
    "general_app_android_view_email_capture",
    "general_app_android_view_phone_capture",
    "general_app_android_view_welcome_screen",
    "general_app_android_view_csp",
    "custom_events_general_app_android_back_alert_end_pressed",
]

# Which events count as app events: LIKE patterns, plus exact names.
APP_EVENT_LIKE = ["general_app_ios_%", "%general_app_android_%"]
APP_EVENT_EXACT = ["enteredlivelobby"]

# Conditional count in the session rollup.
CSP_SHARED_EVENTS = [
    "general_app_ios_tap_share_3d_model",
    "general_app_ios_nsdk_tap_share_csp_3d_viewer",
]

CSP_VIEW_EVENTS = [
    "general_app_ios_nsdk_view_scan_live_lobby",
    "general_app_ios_view_custom_smile_plan_viewer",
    "general_app_android_view_csp",
]
CONTACT_INFO_EVENTS = [
    "general_app_ios_view_contact_information",
    "general_app_ios_nsdk_view_contact_information",
    "general_app_android_view_email_capture",
]

# Milestones: (output column, kind, event names).  kind is "first" or
# "last" (time of the first / last matching event), "csp_first" /
# "csp_last" (CSP view, or contact info once the user is linked to the web,
# falling back to the link's first web session when the event time is
# missing) or "last_name" (name of the session's last event).
MILESTONES = [
    ("first_3ds_start_time", "first", [
        "general_app_ios_tap_initiate_smile_scanner",
        "general_app_ios_tap_start_your_scan_on_sf",
        "enteredlivelobby",
        "general_app_android_start_your_scan"]),
    ("first_android_back_alert_end", "first", [
        "custom_events_general_app_android_back_alert_end_pressed"]),
    ("first_3ds_end_time_temp", "first", CONTACT_INFO_EVENTS),
    ("first_view_phone_capture_end_time", "first", [
        "general_app_ios_nsdk_view_phonecapture",
        "general_app_ios_view_phone_capture",
        "general_app_android_view_phone_capture"]),
    ("first_opt_out_time", "first", [
        "general_app_ios_nsdk_tap_no_thanks_phone_opt_out",
        "general_app_ios_tap_no_thanks_opt_in"]),
    ("first_entered_waitroom_time", "first", [
        "general_app_ios_nsdk_view_waiting_room",
        "general_app_ios_view_waiting_room",
        "general_app_android_waiting_room"]),
    ("text_notification_opt_in", "first", [
        "general_app_ios_nsdk_tap_sms_tap_opt_in",
        "general_app_ios_tap_opt_in"]),
    ("email_notification_enable", "first", [
        "general_app_ios_tap_email_provided",
        "general_app_ios_nsdk_tap_email_provided",
        "general_app_android_view_phone_capture"]),
    ("viewed_CSP_ready_popup", "first", ["general_app_ios_nsdk_alert_csp_ready"]),
    ("CSP_failed", "first", ["general_app_ios_view_error_message"]),
    ("first_viewed_CSP_time", "csp_first", CSP_VIEW_EVENTS),
    ("last_viewed_CSP_time", "csp_last", CSP_VIEW_EVENTS),
    ("first_CSP_shared_time", "first", [
        "general_app_ios_combo_add_to_cart_on_3d_viewer",
        "general_app_ios_tap_share_3d_model"]),
    ("last_event_name", "last_name", []),
    ("clicked_on_buy_now_time", "first", [
        "general_app_ios_nsdk_see_my_options_combo",
        "general_app_ios_combo_add_to_cart_on_3d_viewer"]),
    ("first_CSP_view_event", "first", CSP_VIEW_EVENTS),
    ("last_CSP_interaction_event", "last", [
        "general_app_ios_nsdk_tap_interaction_with_3d_viewer",
        "general_app_ios_tap_interaction_with_3d_viewer"]),
    ("first_welcome_screen_view", "first", [
        "general_app_ios_view_welcome_screen",
        "general_app_ios_nsdk_view_welcome_screen",
        "general_app_android_view_welcome_screen"]),
    ("first_allow_notifications_click", "first", [
        "general_app_ios_nsdk_tap_enable_notifications_pop_up",
        "general_app_ios_tap_allow_notifications"]),
    ("first_tap_sign_in_welcome_screen", "first", [
        "general_app_ios_nsdk_tap_sign_in_welcome_screen",
        "general_app_ios_tap_sign_in_welcome_screen"]),
    ("first_Launch_general_app_Smile_Maker", "first", [
        "general_app_ios_nsdk_tap_launch_smile_maker_welcome_screen",
        "general_app_ios_tap_launch_smile_maker",
        "general_app_android_start_your_scan"]),
    ("first_tap_buy_now_welcome_screen", "first", [
        "general_app_ios_tap_buy_now_welcome_screen"]),
    ("first_tap_learn_more", "first", [
        "general_app_ios_nsdk_tap_learn_more_welcome_screen"]),
    ("first_tap_go_back_waiting_room", "first", [
        "general_app_ios_nsdk_tap_go_back_waiting_room",
        "general_app_ios_tap_go_back_waiting_room"]),
    ("first_start_smile_maker_video", "first", [
        "general_app_ios_view_smile_maker_video",
        "general_app_android_start_video"]),
    ("first_tap_go_back_smile_maker_video", "first", [
        "general_app_ios_tap_go_back_smile_maker_video"]),
    ("first_tap_already_watched_smile_maker_video", "first", [
        "general_app_ios_tap_already_watched_smile_maker_video"]),
    ("first_skip_smile_maker_video", "first", [
        "general_app_ios_nsdk_tap_skip",
        "general_app_ios_tap_skip_smile_maker_video",
        "general_app_android_tap_skip_video"]),
    ("first_start_user_onboarding", "first", ["general_app_ios_view_onboarding"]),
    ("first_scan_live_lobby_view", "first", [
        "general_app_ios_nsdk_view_scan_live_lobby",
        "general_app_ios_view_scan_live_lobby",
        "general_app_android_view_csp"]),
    ("first_click_get_scanning", "first", [
        "general_app_ios_tap_get_scanning",
        "general_app_android_start_your_scan"]),
    ("first_enable_camera_access_click", "first", [
        "general_app_ios_nsdk_tap_enable_camera_access",
        "general_app_ios_tap_enable_camera_access",
        "general_app_android_enable_camera"]),
    ("first_view_start_questionnaire", "first", [
        "general_app_ios_nsdk_view_start_questionnaire"]),
    ("first_click_questionnaire_not_now", "first", [
        "general_app_ios_nsdk_tap_not_right_now_questionnaire"]),
    ("first_view_questionnaire_information", "first", [
        "general_app_ios_nsdk_view_questionnaire_information"]),
    ("first_view_questionnaire_stackla", "first", [
        "general_app_ios_nsdk_view_questionnaire_stackla"]),
    ("first_view_testimony_questionnaire", "first", [
        "general_app_ios_nsdk_view_testimony_questionnaire"]),
    ("first_view_aligner_options_questionnaire", "first", [
        "general_app_ios_nsdk_view_aligner_options_questionnaire"]),
    ("first_view_pricing_questionnaire", "first", [
        "general_app_ios_nsdk_view_pricing_questionnaire"]),
    ("first_view_lsg_questionnaire", "first", [
        "general_app_ios_nsdk_view_lsg_questionnaire"]),
    ("first_view_finish_questionnaire", "first", [
        "general_app_ios_nsdk_view_finish_questionnaire"]),
]

# Durations in fractional minutes: (output, from milestone, [to milestones,
# first non-null wins]).
DURATIONS = [
    ("CSP_interaction_time_minutes", "first_CSP_view_event", ["last_CSP_interaction_event"]),
    ("smile_maker_video_time", "first_start_smile_maker_video", ["first_start_user_onboarding"]),
    ("skip_smile_maker_video_time", "first_start_smile_maker_video",
     ["first_tap_already_watched_smile_maker_video", "first_skip_smile_maker_video"]),
]

# The 3D-scan end only counts when it follows the start and the Android
# back alert never fired.
SCAN_END = ("first_3ds_end_time", "first_3ds_end_time_temp", "first_3ds_start_time",
            "first_android_back_alert_end")

# Column order of the milestone block in the published model (derived
# columns sit right after their inputs).
MILESTONE_OUTPUT_ORDER = [
    "first_3ds_start_time", "first_android_back_alert_end", "first_3ds_end_time_temp",
    "first_3ds_end_time", "first_view_phone_capture_end_time", "first_opt_out_time",
    "first_entered_waitroom_time", "text_notification_opt_in", "email_notification_enable",
    "viewed_CSP_ready_popup", "CSP_failed", "first_viewed_CSP_time", "last_viewed_CSP_time",
    "first_CSP_shared_time", "last_event_name", "clicked_on_buy_now_time",
    "first_CSP_view_event", "last_CSP_interaction_event", "CSP_interaction_time_minutes",
    "first_welcome_screen_view", "first_allow_notifications_click",
    "first_tap_sign_in_welcome_screen", "first_Launch_general_app_Smile_Maker",
    "first_tap_buy_now_welcome_screen", "first_tap_learn_more",
    "first_tap_go_back_waiting_room", "first_start_smile_maker_video",
    "first_tap_go_back_smile_maker_video", "first_tap_already_watched_smile_maker_video",
    "first_skip_smile_maker_video", "first_start_user_onboarding", "smile_maker_video_time",
    "skip_smile_maker_video_time", "first_scan_live_lobby_view", "first_click_get_scanning",
    "first_enable_camera_access_click", "first_view_start_questionnaire",
    "first_click_questionnaire_not_now", "first_view_questionnaire_information",
    "first_view_questionnaire_stackla", "first_view_testimony_questionnaire",
    "first_view_aligner_options_questionnaire", "first_view_pricing_questionnaire",
    "first_view_lsg_questionnaire", "first_view_finish_questionnaire",
]

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------


def app_vocabulary() -> list[str]:
    """Every event name the model reacts to, plus names it must ignore.

    Used by the driver-table adapter to relabel raw events; sorted so the
    relabelling is stable.  The extra names test the event filter: one
    non-app name and one that only matches the LIKE pattern because ``_``
    is a single-character wildcard.
    """
    names = set(APP_VIEW_EVENTS) | set(APP_EVENT_EXACT) | set(CSP_SHARED_EVENTS)
    for _, _, events in MILESTONES:
        names |= set(events)
    names |= set(CONTACT_INFO_EVENTS)
    names |= {"web_page_view", "general_appxios_view_welcome_screen"}
    return sorted(names)
