"""Schemas and settings that the operators share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MISSING, RARE, BOS, EOS = "<missing>", "<rare>", "<bos>", "<eos>"
#: Cluster ids with a meaning: noise, and the transition table of all journeys together.
NOISE, GLOBAL = -1, -999

#: An event stream, and its total order.
STREAM = ("platform", "session_id")
ORDER = ("event_time", "source_file", "source_row_number")

_S = T.StringType()
CANONICAL = T.StructType([
    *(T.StructField(c, _S) for c in ("record_id", "device_id", "customer_id", "session_id", "platform")), T.StructField("event_time", T.TimestampType()),
    *(T.StructField(c, _S) for c in ("event_type", "segment_name", "screen_id", "event_token", "screen_context")),
    T.StructField("gap_prev_seconds", T.DoubleType()), T.StructField("gap_next_seconds", T.DoubleType()), T.StructField("source_file", _S), T.StructField("source_row_number", T.LongType()),
])

#: Screens that contain others, screens of a start, and home screens.
CHROME_SCREENS = (
    "MainTabBarController", "BaseNavigation", "UINavigationController", "UIViewController", "UITrackingElementWindowController",
    "_UISceneHostingViewController", "UIHostingController<PopupView>", "SFBrowserRemoteViewController", "SFAuthenticationViewController",
    "SFSafariViewController", "WebkitEcommerceController", "HiWebViewActivity", "WebViewActivity",
)
BOOT_SCREENS = ("SplashVC", "SplashActivity", "Splash", "MainAppActivity", "LaunchScreen")
ROOT_SCREENS = ("HomeVC", "HomeGuestVC", "HOME", "android/Home", "guest/HOME")
#: Query keys that change what is seen; parts of names of gestures that go back, and of sign-in actions.
QUERY_KEYS = ("tab", "cat_id", "categoryid", "ordertype", "type", "step", "mode", "view", "status")
BACK_MARKERS = ("btn_back", "backbutton", "handleback", "nav_back", "/back", "goback", "close", "dismiss", "cancel")
AUTH_MARKERS = ("continue_login", "login_with", "click_login", "log_out", "logout", "sign_out", "signin_success")
#: Other headers of input columns, the first that is present wins.
ALIASES = {
    "platform": ("segmentation.segment", "segmentation_segment"), "segmentation_name": ("segmentation.name",), "client_time": ("timestamp",),
    "screen_id": ("segmentation.screen_id", "segmentation_screen_id"), "_id": ("_id.$oid",),
}


@dataclass(frozen=True)
class SegmentRules:
    """When a journey ends: a longer pause, a full journey, a return to a root screen, a sign-in or sign-out."""

    idle_seconds: float = 90.0
    longest: int = 80
    cut_on_root: bool = True
    root_after: int = 6
    cut_on_auth: bool = True
    roots: tuple[str, ...] = ROOT_SCREENS
    auth_markers: tuple[str, ...] = AUTH_MARKERS
    shortest: int = 3


@dataclass(frozen=True)
class CleanRules:
    """What is taken out of a journey's tokens before it is summed up."""

    runs: bool = True
    cycles: bool = True
    longest_cycle: int = 4
    repeats: int = 2
    drop_chrome: bool = True
    drop_boot: bool = True
