"""Schemas of snapshots, raw catalogues and payloads.

The three catalogues are called A (pages with a print page and a materials page), B (pages
listed by category) and C (JSON listing with JSON details).
"""

from __future__ import annotations

# Fixed values from here on: column names and payload keys.
PAGES = "page_id bigint, url string, html string"

LOG_A = "show_url string, status string"
SNAPSHOT_B = "url string, filter string"
SNAPSHOT_C = "sid bigint"

CHARACTERS = "array<struct<Name:string,Age:string,Gender:string,Description:string>>"
SONGS_A = "array<struct<song_title:string,song_url:string>>"
CREDITS = "map<string,array<string>>"

RAW_A = f"""
    show_title string, logo_url string, show_url string, brief_synopsis string, dance_requirement string,
    number_of_roles string, rating_of_show string, number_of_acts string, cast_size string, cast_type string,
    characters {CHARACTERS}, songs {SONGS_A}, billing {CREDITS}, tags array<string>,
    similar_shows array<struct<show_name:string,show_url:string>>,
    orchestration_resources struct<Materials:array<struct<Resource:string,Quantity:string>>,
        Orchestration:map<string,array<struct<Instrumentation:string,Doubling:string,Quantity:string>>>>,
    video_warning string, credit_requirements string, awards {CREDITS}, version string, full_synopsis string,
    available_resource array<struct<resource_name:string,resource_link:string,resource_description:string,
        resource_type:string,resource_logo:string>>,
    synopsis_brief string, show_availability string
"""

RAW_B = """
    show_title string, show_type string, show_url string, book_and_music_by array<string>, logo_url string,
    casting_info string, cast_list array<string>, apply_for_license string, show_credits string,
    orchestral_information_list array<string>,
    upcoming_productions array<struct<production_date:string,location:string>>,
    songs_list array<struct<song_name:string,song_url:string>>, related_shows_urls array<string>,
    resources array<struct<resource_name:string,resource_url:string>>, synopsis array<string>,
    community struct<sets:array<string>,costumes:array<string>,props:array<string>>
"""

LISTING_PAYLOAD = """struct<ProductTotal:bigint, Products:array<struct<
    Id:bigint, Name:string, SeName:string, TitleCasting:string, TitleTypeOfPlayAndGenre:string,
    Authors:array<struct<Id:bigint,FirstName:string,LastName:string>>, Tags:array<string>,
    ProductImages:array<struct<Id:bigint,Type:string,Height:int,ImageUrl:string,PhotoCredit:string>>,
    ShortDescription:string>>>"""

DETAIL_PAYLOAD = """struct<
    Id:bigint, ShortDescription:string, FullDescription:string, LicensingFeeDisplay:string,
    TitleAttributeDisplayModel:struct<DescriptionDuration:string, DescriptionTargetAudience:string,
        DescriptionAwards:string, DescriptionProductionInformation:string,
        PerformanceGroups:array<struct<Name:string>>>>"""

# Site addresses, URL forms and page sizes.
SITE_A = "https://www.mtishows.com"
SITE_A_SHORT = "www.mtishows.com"
LISTING_SIZE_C = 150
PRODUCT_URL_C = "https://www.concordtheatricals.com/p/"
DETAIL_URL_C = "https://www.concordtheatricals.com/api/v1/products/"
LICENSE_URL_C = "https://license.concordtheatricals.com/performance-license/license?productId="
