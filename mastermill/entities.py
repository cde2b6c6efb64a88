"""The ten entity specifications.

Fixed values: column names and types, file-name prefixes per region, key columns, dimension names and the
columns an update leaves alone. They must equal those of the tables and extracts they describe.
"""

from __future__ import annotations

from .spec import EntitySpec, GateRule, LookupRule, columns, register

ALTERNATE_PARTS = EntitySpec(
    name="alternate_parts",
    files={"AUS": "AUSALTPART_2024"},
    schema=columns("""
        name string, code int, root_part string, xref_part string, diff_flg string, diff_str string,
        brandsort string, rgcd string
    """),
    keys=("root_part", "xref_part"),
    region_default=True,
)

BILL_OF_MATERIALS = EntitySpec(
    name="bill_of_materials",
    files={"AUS": "AUSBOM_2024"},
    schema=columns("""
        name string, code int, assemb string, lineno int, compnt string, comst string, comqty int,
        crtdat timestamp, revdat timestamp, revnum string
    """),
    keys=("assemb", "compnt"),
)

CUSTOMER = EntitySpec(
    name="customer",
    files={"AUS": "customer_as4us", "OCA": "OCACUST_2024"},
    schema=columns("""
        chainc string, chnl string, cbseg string, grp string, mngrp string, subgrp_d string,
        mngrp_d string, shpto_d string, sldto_d string, chaind string, chnldesc string, grp_d string,
        shpto string, sldto string, custid string, name string, custid_d string, custsts string,
        csubtype string, ctype string, export string, fds string, pdcflag string, sales string,
        bgrp string, cprog string, cdisccd int, cdiscp double, curr string, subgrp int, cusgrp string,
        region string, catcd string, geo string, xrefcd string, housef string, mkupf string,
        mercf string, discf string, euccf string, eucprcl string, mmexcl string, code string
    """),
    keys=("custid",),
    constants={"grp": "", "mngrp": ""},
    drop=("sldtd", "mmbygrp", "sldtod", "mmexcll", "record_action"),
    # One chain, group, ship-to or sold-to may own a large share of the customers: ``spread`` divides its rows
    # once the dimension is too large to broadcast.
    rules=(
        register("chainc", "x_chain", spread=True),
        register("chnl", "x_channel", spread=True),
        register("grp", "x_customer_group", spread=True),
        register("mngrp", "x_customer_main_group", spread=True),
        register("shpto", "x_ship_to", prefix=6, spread=True),
        register("sldto", "x_sold_to", prefix=6, spread=True),
    ),
    not_updated=("sldto_d",),
    validation_status=" ",
)

CUSTOMER_PART_NUMBERS = EntitySpec(
    name="customer_part_numbers",
    files={"OCA": "OCACUSPNUM_2024", "AUS": "AUSCUSPNUM_2024"},
    schema=columns("""
        new_code int, record_action string, rgcd string, pkgspc int, id int, tfcusxrf int, xfmcar string,
        code int, name string, xcuscd string, xdesc string, cpalqt int, xrfptno string, cmstqt int,
        ukgspc string, cuntuk int, cuntpk int, xdiskno string, repack string, xricno string, xstat string,
        xdate timestamp
    """),
    keys=("rgcd", "xrfptno", "xricno"),
    constants={"rgcd": "US"},
    drop=("record_action", "pkgspc", "cuntpk"),
    not_updated=("new_code",),
)

FRANCHISE = EntitySpec(
    name="franchise",
    files={"AUS": "AUSFRAN_2024"},
    schema=columns("""
        name string, code int, frands string, francdn int, frprotect string, frovr string,
        froemflag string, frdstflag string, freucflag string, frmerpbook string, freucpbook string,
        fransmsg string, paexcept int
    """),
    keys=("francdn",),
)

FRANCHISE_CODE_MAP = EntitySpec(
    name="franchise_code_map",
    files={"AUS": "AUSFRANMAP_2024"},
    schema=columns("name string, fdscd string, fsoldt string, fshipt string, frchdisp int, code int"),
    keys=("fsoldt", "frchdisp", "fdscd"),
)

INVOICE_LINES = EntitySpec(
    name="coninv",
    files={"AUS": "AUSINVDTL_2024", "OCA": "OCAINVDTL_2024"},
    schema=columns("""
        name string, code int, cpartno string, ctrck string, cprccd string, csolcd string, cfill1 string,
        cprbtg string, crefcd string, cdirsh string, cshpfr string, cshpto string, cuntdn string,
        cdistg string, ccuspo string, cttm string, cstate string, crdeal string, creman string,
        crdlr string, comgen string, crapid string, cfill3 string, cintfl string, cintin string,
        cfill2 string, cordno decimal(16,6), cinvno decimal(16,6), cuntpr decimal(16,6),
        cqtshp decimal(16,6), csdcst decimal(16,6), cnslpr decimal(16,6), cpbamt decimal(16,6),
        ccordt timestamp, crcore decimal(16,6), cinvdt timestamp, cshpdt timestamp,
        clstprc decimal(16,6)
    """),
    keys=("cordno", "cinvno", "cpartno"),
)

PART_REGIONAL = EntitySpec(
    name="part_regional",
    files={"CA": "ACAPARTREG_2024", "OCA": "OCAPARTREG_2024", "AUS": "AUSPARTREG_2024"},
    schema=columns("""
        name string, brnd_cd int, gbb int, lfcycle int, mktcd string, mfgcc int, prod_cd1 int,
        prod_cd3 int, mfgpdcd int, prdmgr int, part_num string, code string, long_ptno string,
        projcst decimal(16,6), prod_cd5 string, cr_dt timestamp, shrt_desc string, long_desc string,
        fran_code string, prtcls decimal(16,6), sup_prt string, sup_dt timestamp, prtstat string,
        popcdny string, popcdcy string, pllqty int, drop_ship string, cat_cd string, cc1 string,
        cc2 string, cc3 string, cc4 string, cc5 string, sac string, uac string, stdcst decimal(16,6),
        crcst decimal(16,6), lprc decimal(16,6), crprc decimal(16,6), stdmcrcst decimal(16,6),
        lpp_prc decimal(16,6), lppqty int, lppdt timestamp, lppvndr string, postdt timestamp,
        poenddt timestamp, povndr string, pofgt string, popblp decimal(16,6), popblq int, popt string,
        pocurr string, pofdc string, uytd int, uy1qty int, uy2qty int, uy3qty int, uy4qty int,
        uy5qty int, mfgnr string, mfgcommcd string, mfgfamcd string, pnf_fmsi string, mktcdl1 string,
        mktcdl2 int, mktcdl3 int, mktcdl4 int, mktcdl5 int, kit_flag string, cr_gp string,
        core_part string, origin string, nonrtn string, harcode int, ldtime decimal(16,6), upc int,
        vmrs string, height decimal(16,6), prtlen decimal(16,6), prtwid decimal(16,6), planner string,
        buyer string, cystdmtl decimal(16,6), dutfrgexc decimal(16,6), dutycst decimal(16,6),
        frgtcst decimal(16,6), mfglabcst decimal(16,6), whburcst decimal(16,6), mfgbcst decimal(16,6),
        warbcst decimal(16,6), pckcst decimal(16,6), corqty int, vndrnm string, vndrcd string,
        rgcd string, sub_brand int, part_uofm string, rg_part string
    """),
    keys=("part_num",),
    region_default=True,
    merge_keys=("part_num", "rgcd"),
    constants={"prdmgr": 1, "brnd_cd": 1},
    drop=("lpp_part",),
    category_ladder=True,
    rules=(
        register("prod_cd5", "x_product_code_1_digit", "prod_cd1", prefix=1, spread=True),
        register("prod_cd5", "x_product_code_3_digit", "prod_cd3", prefix=3, spread=True),
        LookupRule(
            "mktcd",
            "x_market_code",
            {f"mktcdl{n}": (f"level{n}", "int") for n in range(1, 6)},
            missing="null",
            require_source=True,
            spread=True,
        ),
        LookupRule("part_num", "p_lifecycle_stage", {"lfcycle": ("id", "bigint")}, missing="null"),
        LookupRule("rgcd", "p_pricing_region", {"rgcd": ("id", "bigint")}, missing="drop", spread=True),
        register("part_num", "x_sub_brand", "sub_brand"),
        GateRule(
            "part_num",
            actions="p_pricing_action_detail",
            flags="view_x_yes_no_flag",
            columns=("fran_code", "prod_cd5", "brnd_cd"),
            guard=("franc_code", "brand_code", "prod_code"),
        ),
    ),
    target_extra=columns("mktcd_d string, mfgpdd string, mfgcd string, cbseg string"),
    narrow=("prtcls", "crcst", "lprc", "crprc"),
    validation_status=" ",
)

SUPPLIER = EntitySpec(
    name="supplier",
    files={"AUS": "AUSSUPPLR_2024"},
    schema=columns("""
        name string, vastat string, code int, vacode string, vaname string, vaadr1 string, vaadr2 string,
        vcity string, vstate string, vzip string, vcntct string, vaactr string, vphone string,
        vreltp string, vndtyp string, inter int, dom int, rgcd string
    """),
    keys=("vacode", "rgcd"),
    drop=("record_action",),
    region_default=True,
    not_updated=("inter", "dom"),
)

TECHNICAL_PART_DETAILS = EntitySpec(
    name="technical_part_details",
    files={"AUS": "AUSTECHATT_2024"},
    schema=columns("""
        name string, part_num string, code string, reggrp string, app string, brakesz string,
        bushtype string, flngdm string, indnum string, ltapdm string, loorunlo string, oem string,
        roddm string, stapdm string, sctre string, sthrddm string, style string, taplen string,
        tubtype string, a1_type string, nospline string, beardm string, series string, splen string,
        ewalltk string, crosslen string, ykdim string, axleapp string, axleser string, bpw string,
        bcd string, bhd string, brtype string, efflen string, fmsi string, grade string, headsty string,
        hubsty string, hubtype string, kpdm string, kplen string, kptype string, lorr string, len string,
        model string, norrem string, oeman string, ratio string, f_type string, ydimae string,
        chmbrty string, cssc string, headty string, ssc string, spldm string, hubcaps string,
        noaxles string, singletr string, axlemod string, spintype string, ctype string, oasslen string,
        conntype string, indm string, sysconfg string, isdm string, clutch string, torque string,
        bore string, convst string, ptype string, compty string, sc4thick string, bodydm string,
        colllen string, exlen string, cte string, collst string, toolt string, frictmix string,
        position string, ctelen string, sensor string, gawr string, class string, lrank string,
        brand string, genafter string, trotor string, teeth string, odmmm string, odm string,
        leader string, family string, vndr string, caltype string, tubodm string, rgcd string
    """),
    keys=("part_num", "rgcd"),
    region_default=True,
    drop=("action", "tubtyoe", "type", "odm59", "odm60"),
    keep_code=True,
)

ENTITIES: dict[str, EntitySpec] = {
    spec.name: spec
    for spec in (
        ALTERNATE_PARTS,
        BILL_OF_MATERIALS,
        CUSTOMER,
        CUSTOMER_PART_NUMBERS,
        FRANCHISE,
        FRANCHISE_CODE_MAP,
        INVOICE_LINES,
        PART_REGIONAL,
        SUPPLIER,
        TECHNICAL_PART_DETAILS,
    )
}
