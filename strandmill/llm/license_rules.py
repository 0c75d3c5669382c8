"""Signature rules of the licence scan: hand-written patterns, one line a rule.

Each line: priority, label, keyword, pattern. Lower priority numbers win. The keyword is in every
text that the pattern matches, as a whole run of ASCII letters and digits, in any case. Patterns are
matched without regard to the case of ASCII letters; _ stands for a gap of one or more characters
that are not ASCII letters or digits.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    priority: int
    label: str
    keyword: str
    pattern: str


#: How sure a detection of each priority is.
WEIGHTS = {1: 1.0, 2: 0.95, 3: 0.9, 4: 0.8, 5: 0.5}

RULES_TEXT = r"""
1 gpl-1.0 spdx spdx_license_identifier_gpl_1\.0(?:_only|_or_later|\+)?
1 gpl-2.0 spdx spdx_license_identifier_gpl_2\.0(?:_only)?
1 gpl-2.0-or-later spdx spdx_license_identifier_gpl_2\.0(?:_or_later|\+)
1 gpl-3.0 spdx spdx_license_identifier_gpl_3\.0(?:_only)?
1 gpl-3.0-or-later spdx spdx_license_identifier_gpl_3\.0(?:_or_later|\+)
1 lgpl-2.0 spdx spdx_license_identifier_lgpl_2\.0(?:_only|_or_later|\+)?
1 lgpl-2.1 spdx spdx_license_identifier_lgpl_2\.1(?:_only)?
1 lgpl-2.1-or-later spdx spdx_license_identifier_lgpl_2\.1(?:_or_later|\+)
1 lgpl-3.0 spdx spdx_license_identifier_lgpl_3\.0(?:_only)?
1 lgpl-3.0-or-later spdx spdx_license_identifier_lgpl_3\.0(?:_or_later|\+)
1 agpl-3.0 spdx spdx_license_identifier_agpl_3\.0(?:_only|_or_later|\+)?
1 gfdl-1.3 spdx spdx_license_identifier_gfdl_1\.[0-9](?:_only|_or_later)?
1 apache-1.1 spdx spdx_license_identifier_apache_1\.1
1 apache-2.0 spdx spdx_license_identifier_apache_2\.0
1 mit spdx spdx_license_identifier_mit
1 mit-0 spdx spdx_license_identifier_mit_0
1 x11 spdx spdx_license_identifier_x11
1 bsd-2-clause spdx spdx_license_identifier_bsd_2_clause
1 bsd-3-clause spdx spdx_license_identifier_bsd_3_clause
1 bsd-4-clause spdx spdx_license_identifier_bsd_4_clause
1 0bsd spdx spdx_license_identifier_0bsd
1 isc spdx spdx_license_identifier_isc
1 mpl-1.1 spdx spdx_license_identifier_mpl_1\.1
1 mpl-2.0 spdx spdx_license_identifier_mpl_2\.0
1 epl-1.0 spdx spdx_license_identifier_epl_1\.0
1 epl-2.0 spdx spdx_license_identifier_epl_2\.0
1 cddl-1.0 spdx spdx_license_identifier_cddl_1\.[01]
1 eupl-1.2 spdx spdx_license_identifier_eupl_1\.[12]
1 cc0-1.0 spdx spdx_license_identifier_cc0_1\.0
1 cc-by-4.0 spdx spdx_license_identifier_cc_by_4\.0
1 cc-by-3.0 spdx spdx_license_identifier_cc_by_3\.0
1 cc-by-sa-4.0 spdx spdx_license_identifier_cc_by_sa_4\.0
1 cc-by-nc-4.0 spdx spdx_license_identifier_cc_by_nc_4\.0
1 unlicense spdx spdx_license_identifier_unlicense
1 wtfpl spdx spdx_license_identifier_wtfpl
1 zlib spdx spdx_license_identifier_zlib
1 boost-1.0 spdx spdx_license_identifier_bsl_1\.0
1 artistic-2.0 spdx spdx_license_identifier_artistic_2\.0
1 python-2.0 spdx spdx_license_identifier_(?:python|psf)_2\.0
1 ofl-1.1 spdx spdx_license_identifier_ofl_1\.1
1 postgresql spdx spdx_license_identifier_postgresql
1 ncsa spdx spdx_license_identifier_ncsa
1 afl-3.0 spdx spdx_license_identifier_afl_3\.0
1 osl-3.0 spdx spdx_license_identifier_osl_3\.0
1 busl-1.1 spdx spdx_license_identifier_busl_1\.1
1 sspl-1.0 spdx spdx_license_identifier_sspl_1\.0
2 gpl-1.0 gnu gnu_general_public_license(?:_as_published_by_the_free_software_foundation)?_(?:version|v)_?1
2 gpl-2.0 gnu gnu_general_public_license(?:_as_published_by_the_free_software_foundation)?_(?:version|v)_?2(?:\.0)?
2 gpl-3.0 gnu gnu_general_public_license(?:_as_published_by_the_free_software_foundation)?_(?:version|v)_?3(?:\.0)?
2 gpl-2.0-or-later gnu gnu_general_public_license(?:_as_published_by_the_free_software_foundation)?_either_version_2
2 gpl-3.0-or-later gnu gnu_general_public_license(?:_as_published_by_the_free_software_foundation)?_either_version_3
2 lgpl-2.0 gnu gnu_library_general_public_license(?:_version_2(?:\.0)?)?
2 lgpl-2.1 gnu gnu_lesser_general_public_license(?:_as_published_by_the_free_software_foundation)?_(?:either_)?(?:version|v)_?2\.1
2 lgpl-3.0 gnu gnu_lesser_general_public_license(?:_as_published_by_the_free_software_foundation)?_(?:either_)?(?:version|v)_?3(?:\.0)?
2 agpl-3.0 gnu gnu_affero_general_public_license(?:_as_published_by_the_free_software_foundation)?_(?:either_)?(?:version|v)_?3(?:\.0)?
2 gfdl-1.3 gnu gnu_free_documentation_license(?:_version_1\.[0-9])?
2 gpl-2.0 gplv2 gplv2
2 gpl-3.0 gplv3 gplv3
2 gpl-2.0 gpl gpl_(?:v|version_)?2(?:\.0)?
2 gpl-3.0 gpl gpl_(?:v|version_)?3(?:\.0)?
2 lgpl-2.1 lgpl lgpl_(?:v|version_)?2\.1
2 lgpl-3.0 lgpl lgpl_(?:v|version_)?3(?:\.0)?
2 lgpl-3.0 lgplv3 lgplv3
2 agpl-3.0 agpl agpl_(?:v|version_)?3(?:\.0)?
2 agpl-3.0 agplv3 agplv3
2 apache-1.0 apache apache_(?:software_)?license_(?:version_)?1\.0
2 apache-1.1 apache apache_(?:software_)?license_(?:version_|v)?1\.1
2 apache-2.0 apache apache_(?:software_)?license_(?:version_|v)?2(?:\.0)?
2 apache-2.0 apache apache_2\.0(?:_license)?
2 apache-2.0 asl asl_2\.0
2 bsd-2-clause bsd (?:2|two)_clause_bsd(?:_license)?
2 bsd-2-clause bsd bsd_(?:2|two)_clause(?:_license)?
2 bsd-2-clause bsd simplified_bsd(?:_license)?
2 bsd-2-clause freebsd freebsd_license
2 bsd-3-clause bsd (?:3|three)_clause_bsd(?:_license)?
2 bsd-3-clause bsd bsd_(?:3|three)_clause(?:_license)?
2 bsd-3-clause bsd (?:new|modified|revised)_bsd(?:_license)?
2 bsd-4-clause bsd (?:4|four)_clause_bsd(?:_license)?
2 bsd-4-clause bsd bsd_(?:4|four)_clause(?:_license)?
2 bsd-4-clause bsd (?:original|old)_bsd(?:_license)?
2 0bsd 0bsd 0bsd(?:_license)?
2 mpl-1.0 mozilla mozilla_public_license_(?:version_|v_?)?1\.0
2 mpl-1.1 mozilla mozilla_public_license_(?:version_|v_?)?1\.1
2 mpl-2.0 mozilla mozilla_public_license_(?:version_|v_?)?2\.0
2 mpl-2.0 mpl mpl_(?:v|version_)?2(?:\.0)?
2 mpl-1.1 mpl mpl_(?:v|version_)?1\.1
2 epl-1.0 eclipse eclipse_public_license_(?:version_|v_?)?1\.0
2 epl-2.0 eclipse eclipse_public_license_(?:version_|v_?)?2\.0
2 edl-1.0 eclipse eclipse_distribution_license_(?:version_|v_?)?1\.0
2 cpl-1.0 common common_public_license_(?:version_|v_?)?1\.0
2 ipl-1.0 ibm ibm_public_license(?:_version_1\.0)?
2 cddl-1.0 cddl cddl_(?:v|version_)?1\.0
2 cddl-1.1 cddl cddl_(?:v|version_)?1\.1
2 cddl-1.0 common common_development_and_distribution_license(?:_(?:version_|v_?)?1\.0)?
2 eupl-1.1 european european_union_public_licen[cs]e_(?:version_|v_?)?1\.1
2 eupl-1.2 european european_union_public_licen[cs]e_(?:version_|v_?)?1\.2
2 cecill-2.1 cecill cecill(?:_free_software)?(?:_license)?_(?:agreement_)?(?:version_|v_?)?2\.1
2 cc-by-1.0 cc cc_by_1\.0
2 cc-by-2.0 cc cc_by_2\.0
2 cc-by-2.5 cc cc_by_2\.5
2 cc-by-3.0 cc cc_by_3\.0
2 cc-by-4.0 cc cc_by_4\.0
2 cc-by-sa-2.0 cc cc_by_sa_2\.0
2 cc-by-sa-3.0 cc cc_by_sa_3\.0
2 cc-by-sa-4.0 cc cc_by_sa_4\.0
2 cc-by-nc-2.0 cc cc_by_nc_2\.0
2 cc-by-nc-3.0 cc cc_by_nc_3\.0
2 cc-by-nc-4.0 cc cc_by_nc_4\.0
2 cc-by-nd-3.0 cc cc_by_nd_3\.0
2 cc-by-nd-4.0 cc cc_by_nd_4\.0
2 cc-by-nc-sa-3.0 cc cc_by_nc_sa_3\.0
2 cc-by-nc-sa-4.0 cc cc_by_nc_sa_4\.0
2 cc-by-nc-nd-3.0 cc cc_by_nc_nd_3\.0
2 cc-by-nc-nd-4.0 cc cc_by_nc_nd_4\.0
2 cc-by-4.0 creative creative_commons_attribution_4\.0(?:_international)?(?:_public)?(?:_license)?
2 cc-by-3.0 creative creative_commons_attribution_3\.0(?:_unported)?(?:_license)?
2 cc-by-sa-4.0 creative creative_commons_attribution_share_?alike_4\.0(?:_international)?(?:_public)?(?:_license)?
2 cc-by-sa-3.0 creative creative_commons_attribution_share_?alike_3\.0(?:_unported)?(?:_license)?
2 cc-by-nc-4.0 creative creative_commons_attribution_non_?commercial_4\.0(?:_international)?(?:_public)?(?:_license)?
2 cc-by-nc-sa-4.0 creative creative_commons_attribution_non_?commercial_share_?alike_4\.0(?:_international)?(?:_public)?(?:_license)?
2 cc-by-nd-4.0 creative creative_commons_attribution_no_?derivatives_4\.0(?:_international)?(?:_public)?(?:_license)?
2 cc-by-nc-nd-4.0 creative creative_commons_attribution_non_?commercial_no_?derivatives_4\.0(?:_international)?(?:_public)?(?:_license)?
2 cc0-1.0 cc0 cc0(?:_1\.0)?(?:_universal)?
2 cc0-1.0 creative creative_commons_zero(?:_v?1\.0)?(?:_universal)?
2 odbl-1.0 open open_database_license(?:_(?:version_|v_?)?1\.0)?
2 odc-by-1.0 open open_data_commons_attribution_license
2 pddl-1.0 public public_domain_dedication_and_license
2 artistic-1.0 artistic artistic_license_(?:version_|v_?)?1\.0
2 artistic-2.0 artistic artistic_license_(?:version_|v_?)?2\.0
2 boost-1.0 boost boost_software_license(?:_version)?(?:_1\.0)?
2 zlib zlib zlib(?:_libpng)?_license
2 libpng libpng libpng_license
2 isc isc isc_license
2 ncsa illinois university_of_illinois(?:_ncsa)?_open_source_license
2 postgresql postgresql postgresql_licen[cs]e
2 python-2.0 python python_(?:software_foundation_)?license(?:_version_2(?:\.0)?)?
2 ruby ruby ruby_license
2 php-3.01 php php_license(?:_(?:version_|v_?)?3\.01)?
2 openssl openssl openssl_license
2 curl curl curl_license
2 vim vim vim_license
2 tcl tcl tcl_tk_license
2 w3c w3c w3c_software(?:_notice_and)?_license
2 ofl-1.1 sil sil_open_font_license(?:_(?:version_|v_?)?1\.1)?
2 ofl-1.1 ofl ofl_1\.1
2 lppl-1.3c latex latex_project_public_license(?:_(?:version_|v_?)?1\.3c?)?
2 ms-pl microsoft microsoft_public_license
2 ms-rl microsoft microsoft_reciprocal_license
2 apsl-2.0 apple apple_public_source_license(?:_(?:version_|v_?)?2\.0)?
2 afl-3.0 academic academic_free_license(?:_(?:version_|v_?)?3\.0)?
2 osl-3.0 open open_software_license(?:_(?:version_|v_?)?3\.0)?
2 unlicense unlicense (?:the_)?unlicense
2 wtfpl wtfpl wtfpl(?:_version_2)?
2 wtfpl fuck do_what_the_fuck_you_want_to_public_license
2 beerware beerware (?:the_)?beerware_license
2 upl-1.0 universal universal_permissive_license(?:_(?:version_|v_?)?1\.0)?
2 mulan-2.0 mulan mulan_(?:psl|permissive_software_license)_(?:version_|v_?)?2
2 sspl-1.0 server server_side_public_license(?:_(?:version_|v_?)?1)?
2 busl-1.1 business business_source_license(?:_1\.1)?
2 elastic-2.0 elastic elastic_license(?:_2\.0)?
2 commons-clause commons commons_clause
2 polyform polyform polyform_(?:noncommercial|small_business|shield|strict)(?:_license)?
2 openrail openrail (?:bigscience_|creativeml_)?open_?rail(?:_m)?(?:_license)?
2 jsr-spec sun sun_binary_code_license
2 x11 x11 x11_license
2 mit expat expat_license
2 hpnd historical historical_permission_notice_and_disclaimer
2 zpl-2.1 zope zope_public_license(?:_(?:version_|v_?)?2\.[01])?
2 json json the_software_shall_be_used_for_good_not_evil_json
3 gpl-2.0 gnu (?:https?_)?(?:www_)?gnu\.org_licenses_(?:old_licenses_)?gpl_2\.0[a-z.]*
3 gpl-3.0 gnu (?:https?_)?(?:www_)?gnu\.org_licenses_gpl_3\.0[a-z.]*
3 gpl gnu (?:https?_)?(?:www_)?gnu\.org_(?:licenses|copyleft)_gpl[a-z.]*
3 lgpl gnu (?:https?_)?(?:www_)?gnu\.org_(?:licenses|copyleft)_lgpl[a-z.]*
3 agpl-3.0 gnu (?:https?_)?(?:www_)?gnu\.org_licenses_agpl[a-z.]*
3 gfdl gnu (?:https?_)?(?:www_)?gnu\.org_licenses_fdl[a-z.]*
3 apache-2.0 apache (?:https?_)?(?:www_)?apache\.org_licenses_license_2\.0[a-z.]*
3 apache-1.1 apache (?:https?_)?(?:www_)?apache\.org_licenses_license_1\.1[a-z.]*
3 mit opensource (?:https?_)?(?:www_)?opensource\.org_licenses?_mit[a-z.]*
3 bsd-2-clause opensource (?:https?_)?(?:www_)?opensource\.org_licenses?_bsd_2_clause
3 bsd-3-clause opensource (?:https?_)?(?:www_)?opensource\.org_licenses?_bsd_3_clause
3 isc opensource (?:https?_)?(?:www_)?opensource\.org_licenses?_isc
3 mpl-2.0 opensource (?:https?_)?(?:www_)?opensource\.org_licenses?_mpl_2\.0
3 mpl-2.0 mozilla (?:https?_)?(?:www_)?mozilla\.org_(?:en_us_)?mpl_2\.0
3 mpl-1.1 mozilla (?:https?_)?(?:www_)?mozilla\.org_mpl_mpl_1\.1[a-z.]*
3 epl-1.0 eclipse (?:https?_)?(?:www_)?eclipse\.org_legal_epl_v10[a-z.]*
3 epl-2.0 eclipse (?:https?_)?(?:www_)?eclipse\.org_legal_epl_(?:v20|2\.0)[a-z.]*
3 cc-by creativecommons (?:https?_)?(?:www_)?creativecommons\.org_licenses_by_[0-9]\.[0-9]
3 cc-by-sa creativecommons (?:https?_)?(?:www_)?creativecommons\.org_licenses_by_sa_[0-9]\.[0-9]
3 cc-by-nc creativecommons (?:https?_)?(?:www_)?creativecommons\.org_licenses_by_nc_[0-9]\.[0-9]
3 cc-by-nd creativecommons (?:https?_)?(?:www_)?creativecommons\.org_licenses_by_nd_[0-9]\.[0-9]
3 cc-by-nc-sa creativecommons (?:https?_)?(?:www_)?creativecommons\.org_licenses_by_nc_sa_[0-9]\.[0-9]
3 cc-by-nc-nd creativecommons (?:https?_)?(?:www_)?creativecommons\.org_licenses_by_nc_nd_[0-9]\.[0-9]
3 cc0-1.0 creativecommons (?:https?_)?(?:www_)?creativecommons\.org_publicdomain_zero_1\.0
3 cc-pdm creativecommons (?:https?_)?(?:www_)?creativecommons\.org_publicdomain_mark_1\.0
3 unlicense unlicense (?:https?_)?(?:www_)?unlicense\.org
3 wtfpl wtfpl (?:https?_)?(?:www_)?wtfpl\.net
3 boost-1.0 boost (?:https?_)?(?:www_)?boost\.org_license_1_0\.txt
3 ofl-1.1 sil (?:https?_)?scripts\.sil\.org_ofl
3 mit permission permission_is_hereby_granted_free_of_charge_to_any_person_obtaining_a_copy
3 isc permission permission_to_use_copy_modify_and_or_distribute_this_software_for_any_purpose_with_or_without_fee
3 bsd redistribution redistribution_and_use_in_source_and_binary_forms_with_or_without_modification
3 zlib origin the_origin_of_this_software_must_not_be_misrepresented
3 unlicense unencumbered free_and_unencumbered_software_released_into_the_public_domain
3 gpl redistribute redistribute_it_and_or_modify_it_under_the_terms_of_the_gnu_general_public_license
3 lgpl redistribute redistribute_it_and_or_modify_it_under_the_terms_of_the_gnu_lesser_general_public_license
3 agpl-3.0 redistribute redistribute_it_and_or_modify_it_under_the_terms_of_the_gnu_affero_general_public_license
3 apache-2.0 compliance you_may_not_use_this_file_except_in_compliance_with_the_license
3 mpl-2.0 mozilla subject_to_the_terms_of_the_mozilla_public_license
3 bsd-4-clause advertising all_advertising_materials_mentioning_features_or_use_of_this_software
3 bsd-3-clause endorse may_be_used_to_endorse_or_promote_products_derived_from_this_software
3 mit warranty the_software_is_provided_as_is_without_warranty_of_any_kind_express_or_implied
4 gpl gnu gnu_general_public_license
4 lgpl gnu gnu_lesser_general_public_license
4 agpl gnu gnu_affero_general_public_license
4 gpl gnu gnu_gpl
4 lgpl gnu gnu_lgpl
4 gpl gpl (?:the_)?gpl(?:_license)?
4 lgpl lgpl (?:the_)?lgpl(?:_license)?
4 agpl agpl (?:the_)?agpl(?:_license)?
4 apache apache apache_(?:software_)?license
4 mit mit mit_license
4 mit mit mit_x11(?:_license)?
4 bsd bsd bsd(?:_style)?_license
4 mpl mozilla mozilla_public_license
4 epl eclipse eclipse_public_license
4 eupl european european_union_public_licen[cs]e
4 artistic artistic artistic_license
4 cc-by cc cc_by
4 cc-by-sa cc cc_by_sa
4 cc-by-nc cc cc_by_nc
4 cc-by-nd cc cc_by_nd
4 cc-by-nc-sa cc cc_by_nc_sa
4 cc-by-nc-nd cc cc_by_nc_nd
4 cc-by creative creative_commons_attribution(?:_license)?
4 cc-by-sa creative creative_commons_attribution_share_?alike(?:_license)?
4 cc-by-nc creative creative_commons_attribution_non_?commercial(?:_license)?
4 creative-commons creative creative_commons(?:_license)?
4 public-domain domain (?:dedicated_to|released_into|placed_in|in)_the_public_domain
4 proprietary proprietary proprietary_(?:and_confidential|license|software)
4 proprietary reserved all_rights_reserved
4 proprietary confidential confidential_and_proprietary
4 non-commercial commercial (?:for_)?non_commercial_use_only
4 free-restricted redistribute may_not_(?:be_)?redistributed?
4 shareware shareware shareware
4 freeware freeware freeware
5 unknown-license licensed licensed_under(?:_the)?(?:_terms_of)?(?:_the)?
5 unknown-license license see_(?:the_)?license(?:_file)?(?:_for_details)?
5 unknown-license license distributed_under_(?:the_)?(?:terms_of_(?:the_)?)?license
5 unknown-license terms released_under_(?:the_)?terms_of
5 unknown-license released released_under_(?:an?_|the_)?open_source_license
"""

GAP = r"(?:[^A-Za-z0-9]++)"


def rules() -> list[Rule]:
    found = []
    for line in RULES_TEXT.strip().splitlines():
        priority, label, keyword, pattern = line.split(" ", 3)
        found.append(Rule(int(priority), label, keyword, rf"(?i)(?<![A-Za-z0-9])(?:{pattern.replace('_', GAP)})(?![A-Za-z0-9])"))
    return found
