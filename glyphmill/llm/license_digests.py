"""Digests of public licence texts; made by ``licenses.whole_rows`` and ``licenses.long_rows``.

``WHOLE``: the texts as documents, with and without heading, preamble and appendix. ``LONG``: their
terms, to be found inside documents, as ``(license, n_words, head, digest)``.
"""

WHOLE = (
    ("0BSD", "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c"),
    ("Apache-2.0", "14bd6473479943113a186aecce1ae15a2fe828433f79c66b39b7daad6e5bf34e"),
    ("Apache-2.0", "22d30010779648c6943c76d78abf372cd865d3b085c490f47072354cc7dd61c7"),
    ("Apache-2.0", "23917dbb55ec0a97226464ffa67552a84f94eb972e82e419556a0ca34139b155"),
    ("Apache-2.0", "65b0f68c514949c962fd2109fe3df5781ff4b306ffd0c293b4b6d2bd90bfca0d"),
    ("Apache-2.0", "8e23171f434ea7c4a1ed6b46a2bb2c82785df71377a043a1744358596c3aabee"),
    ("Apache-2.0", "f3888435037482fae24800a2a7474293961651ccd29b2f83951215b86eeff9dc"),
    ("Apache-2.0", "fb0374069f02a34b3ed6f9b37df5e2b729016be3d004bdde2011e9f3e34b0588"),
    ("Artistic-1.0", "071fc776527f7049985ab9fe6fddbb0f4e7bbe7724d0ff1c81b59d74f4175dea"),
    ("Artistic-1.0", "93aa47d57763801ed6e6a6591d4d4049a2c46794df90838023ceade56b569da0"),
    ("Artistic-1.0", "bc43b6b1b7514ad91211dc02e099c99c5f685b348d0e4745aab23defc11c558d"),
    ("BSD-2-Clause", "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2"),
    ("BSD-2-Clause", "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2"),
    ("BSD-2-Clause", "5151319f99abfc15f9a1aab05c799faf3b0e5715fac5a5812b9d3566ae984374"),
    ("BSD-2-Clause", "63151a500234e07ef3e50814b0d1d07db92c9481191003b577fbf42336ed40a0"),
    ("BSD-2-Clause", "68f54bd97d77aa7c6d7a3706ff20555e202ff9393a9e5eaf4f0ebede2ff51a1f"),
    ("BSD-2-Clause", "6a5d49c15e02e9e94957d78177d86e8631be9a19549a7cfd2e8c3be2699f00b9"),
    ("BSD-2-Clause", "7be8178e4e9d0dea6ff4b04bd52bd086d7ea8386a5a6e09760df916bae5d42d2"),
    ("BSD-2-Clause", "85c46767b6234227cebe127f5c22b9ede02ee48dda5f148ccefe8432c4d93221"),
    ("BSD-2-Clause", "957c3854a3d72e069e7f5e48857ad9ab76135f14c70d60fa9ec6ef9a928d45dd"),
    ("BSD-2-Clause", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"),
    ("BSD-2-Clause", "9c47a682ef64c4e02c50c208384916c7f80087d4e4395b2b06e65a4c4b08b152"),
    ("BSD-2-Clause", "a11471bc40750a21bd4508891b5626642657a09eaa0ef1ec576be7d37fe5ada8"),
    ("BSD-2-Clause", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-2-Clause", "eda2ad636e738f6a26a2fea902bb734ee48c789a5b40035b8db3659bd951e5bc"),
    ("BSD-2-Clause", "ef3c818b28792f48774a4d16b461004c5e21338f9f74f2664f41f86803c30d60"),
    ("BSD-2-Clause", "f4befedc01589c90d5effeae5f64453726c8fded8e4b6fe6c36f99d303581f1f"),
    ("BSD-3-Clause", "007fde9b266f35183b511c8c01994581175bfdaa48438967e905c31fb50ba523"),
    ("BSD-3-Clause", "0fbd7c43c4bb3e398d262b8e39f58ee0a8709a2b3b6b4bee4e033b3d5755f58d"),
    ("BSD-3-Clause", "109f433fa6d7ddc201aa2bf2527bac4f38143cdcf2ea093dfa07d89074bec856"),
    ("BSD-3-Clause", "1238550805feaeec7ac6f60c2a1b7b3828c3fb1e9d9d52c718c3b75c7b5ff98e"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("BSD-3-Clause", "2cdd19f933f323a30eebbe32aec8e6b66920a61bb8015563b953e080ecd5fb6c"),
    ("BSD-3-Clause", "3d151449461c0c776e892a4dc41cac0d251eb00c9fc49d2d48802d9bed818fe9"),
    ("BSD-3-Clause", "4079d1a9108ca437dd29ac26e1f73dbf7bb3b61ba3392438373db7018cf188c3"),
    ("BSD-3-Clause", "4bfb244e03bb8ff80f6efb1a78cded6cfd77aefc484bcea2baaf4096ac8e1f60"),
    ("BSD-3-Clause", "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa"),
    ("BSD-3-Clause", "69fcedb70fd1930cb5d773bb71eb605a3aec6362c678302194666d60ca468f71"),
    ("BSD-3-Clause", "6fc618780b44cdca4b29e5e2df831e67dfee9bade4a4996c59b815c2bfdb566c"),
    ("BSD-3-Clause", "94a0a44b170114affb7b3975c6987906dca819b6cbd93510aa70be57345a1e3f"),
    ("BSD-3-Clause", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("BSD-3-Clause", "b6ab7953b6c80a72261014244324a70663f1807fa212f52461b24c95eb16b4a9"),
    ("BSD-3-Clause", "cc3432eb2f19bb6fe96706bad75b6fce1039db64fb70486899bf6425dea4d9cb"),
    ("BSD-3-Clause", "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15"),
    ("BSD-3-Clause", "cf77ee3d20f4076cecdb58fc53aa7204c9f5c0651621abbc85e028f5b2ffa6b4"),
    ("BSD-3-Clause", "d0a339eb5454123c6a1f2696aace557e0561866f3fe33b93ffad58ecfcab7060"),
    ("BSD-3-Clause", "e327b35e2b01d84b108447cf1bd62958a3a0431b96631ab4f225c0b10e274f1f"),
    ("BSD-3-Clause", "eabe215ff5a2cf5b1c090915b7cabdf511f70fc79fb8fde85247ebe3038a9658"),
    ("BSD-3-Clause", "ed0104d130ef02966836b3c8fb16c58ca9a91d49ed78ed3281531b463296f124"),
    ("BSD-3-Clause", "f2f49b468edc6b1259a03d37c9635c3525e11ce7388ab69d63d77cf3755741f2"),
    ("BSD-3-Clause", "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af"),
    ("CC0-1.0", "0edbe65c90ba664b89a7536fafe4bfb2b6f1772ee835c378d57392be3cc3a0a6"),
    ("CC0-1.0", "c9fc766f3657f72225d157a552169fb6bc0ba652f321dd55458ae0b62f996a32"),
    ("CC0-1.0", "f077c0c81f151a9e0132ccd0fb879818a7e58947ea58ee16e15daa5548471875"),
    ("GFDL-1.2", "8ccbc8ccc15888419cf8051e2ccc585d1a7b9e6ff11c86eeb529dacac59e75eb"),
    ("GFDL-1.2", "e340fdbffa8aad1a91ad3d07603ae56e4f976876fde20a8f60ddc2324aaafbf2"),
    ("GFDL-1.2", "e68d553bf79bfcf34e10323b7eab1bd07a303e468698cf6560683c2a14a16817"),
    ("GFDL-1.2", "f131b25338dcc1c2d9962e2e9d40373f9ba5cf2584ff377989702f013ca36402"),
    ("GFDL-1.3", "24a1eee50a8a03726d0c9df2bda3fc0c810ea16c6cf6bffc69d49fd4c54a6e12"),
    ("GFDL-1.3", "37eeec0d03c60f321a889fea6415e9eaa8650a571ef484fef41f8790571a5eb0"),
    ("GFDL-1.3", "7db095572ae7d37eac88998a282cddd796464464f3387626f9fa824c6ec59410"),
    ("GFDL-1.3", "a44fc211b6407c21b562aed0caddf6b0bf8a01240f2aff2edb1ecb0be5ca926c"),
    ("GPL-1.0", "018aaaf7231e8a3c8e8a0800c7e593914a330040252f5dc554e1817d1a27f2d4"),
    ("GPL-1.0", "4294e7da6430e7e4dcbc3ffa6aba65d5ee3d7a378887d30664d4b1427a2366b0"),
    ("GPL-1.0", "62f899ce3dcfbe979aa13b91d2cc3747693edb153465273224804803abf0d8e6"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0", "89a2eaeb28a89e3300da5b5e25b323d9506134afce7c19b84d8cefb204527857"),
    ("GPL-1.0", "9e12a40a9b22c45d116f19e1746b08ea0b853519de3e03ceb780f2a36d5f388c"),
    ("GPL-2.0", "01cc17c20d67ea4b9f59b7b4bf120b581530d252eb231629f52f366cd1778a7e"),
    ("GPL-2.0", "13bb5fbb12b278b070b4d85e308178486b70bf3a833fbfa4d013e9155580cdde"),
    ("GPL-2.0", "3efce15753b8dd3e388d3bd1b217a7fc0989583f34aaa2631e82a9a949503f1e"),
    ("GPL-2.0", "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1"),
    ("GPL-2.0", "e4d14510e41435c3eb12c255b72546a3cb9943f06f209c72bc30a19095b08999"),
    ("GPL-2.0", "f350498d9db95d7e636e0d627c59b148799df172f528dcbf1dc16be23cee8e33"),
    ("GPL-3.0", "2b33f9a6d0372d04a22e8cdcbf5ebe1f0f5acb499df0b2f99e73793550c433e7"),
    ("GPL-3.0", "6cc96bdedfec1177c090ab7a56dce4f667f48307309b6cad39f573d614d10d93"),
    ("GPL-3.0", "7f30b2dbc05a247766782b40c76a760bbfbf16f1579641fd488700202788935b"),
    ("GPL-3.0", "8cab3f52ce745f6792f8bfcd8257759debd8c8dfcbff63c00bfbc9cf124f81c2"),
    ("GPL-3.0", "f3fdc8ef70f8375f00c798856135106131bec012d3fcac864b6cd106a94c504f"),
    ("GPL-3.0", "f7bb29d9a31c3a1a68ccff0d8d9053350dc0b10b52b62d46d0f2e36a41e32975"),
    ("ISC", "217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a"),
    ("LGPL-2.0", "11c6bf1f35a7705a7053b56e6d9aa90b44a96d25c094aba5e1eaf42f854529c5"),
    ("LGPL-2.0", "37c95c2fc714b4e2df1e6964997f9ce23af0b56800abe9abddb45c681faa8c93"),
    ("LGPL-2.0", "7af703ae2898d21e30c65a71b3df62410b31c27448f78c4e149efc98cabd24ab"),
    ("LGPL-2.0", "86875a38722956f548be8aaac4a6def4923f749e767d24f82670b219c5b32aa1"),
    ("LGPL-2.0", "b4114daa3dfa52e27e78b2c4e17acd58bf4381e812762f4ded0bcb8eabd1092c"),
    ("LGPL-2.0", "ff773d8d898dfc51ae2dbf3baa20700673e8ceb153b13d26c525af34a59adf0c"),
    ("LGPL-2.1", "294fb9ec58649c7eb0cf90fc2900ac1b28b82fb6da9d40d7599d6b7d399d4d2e"),
    ("LGPL-2.1", "446a8adc2da9c55e139c3564c793b6cc9741cfe224e9d47740bda2d268025527"),
    ("LGPL-2.1", "6b3d992a67db38de52bcd6bac2297117d02ac91fad9075cb151fd0fa64b36bad"),
    ("LGPL-2.1", "963f79d48038eed98d8341c84d8d3b765e99508a738d00654c0112f70a7c370c"),
    ("LGPL-2.1", "b8fbfc001aa5419588154ce5a185caee9d0581cef29a049a72b9f8a6f169de31"),
    ("LGPL-2.1", "d7c240fc6d0c527a2d129eb9126a60576534cdad2a50ef2d7387cde0761999c3"),
    ("LGPL-3.0", "3c109b32fc12cedb18f514c338498353cbbafbc7ad3aa3aed8c864396943f25a"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MIT", "0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c"),
    ("MPL-1.1", "3a104c79ec664ea1684852b6fb6e3a050669d92ef24063f0819f0ada00f2144a"),
    ("MPL-1.1", "8e0d6bce1c9edcccd142522e83c6de084a68b9500d79e6741b8903df3316c55a"),
    ("MPL-1.1", "c3754fa3290eda10675f5ccbdf2525e4717acc479d73ef03524ab7e393bab08c"),
    ("MPL-1.1", "fb84cdb331a381edd811d3017d5400ac2c74d9d8470038f79413ac78b10c2a59"),
    ("MPL-2.0", "2cec6f733aa157c2d0b72e9669f75ca354f332218fcb5a3a885931f385272a04"),
    ("MPL-2.0", "6fa486888db3629632da5c850b1a60a82f16949883bf796db3f20f871e1b090b"),
    ("MPL-2.0", "fa31bb5fe4dacb07f1a4ad162be58edb552e9a96a500b68e081943eb2d3cfec5"),
    ("MPL-2.0", "ff0ec74757965d70d3c750a7848c3cc549386eb7bdf943ffa290c4a94528b513"),
    ("Unlicense", "788cc8843bf483eb3ea3b5f6c317b95502da6e7105963f7c57c872ceb263fd49"),
    ("Unlicense", "e6e60d2037efe58841d698b341a609d8a738effceaadb12ac721e54f8e0bf7db"),
)

LONG = (
    ("0BSD", 98, "permission to use copy", "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c"),
    ("Apache-2.0", 1405, "1 definitions license shall", "41d328385277b2ac2c310f16b156af3740407801519f29de18171772f82acb42"),
    ("Apache-2.0", 1410, "1 definitions license shall", "5d27112d98f6dbe8ba9ca284aeed0f4cc8bb3c51c0f2d8225a621c0d33c7abcb"),
    ("Artistic-1.0", 979, "the intent of this", "005792a186ae0f9402339521d5dab41bfc27543fe405c681d272420976989ca9"),
    ("BSD-2-Clause", 184, "redistribution and use in", "7be8178e4e9d0dea6ff4b04bd52bd086d7ea8386a5a6e09760df916bae5d42d2"),
    ("BSD-2-Clause", 184, "redistribution and use in", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"),
    ("BSD-2-Clause", 186, "redistribution and use in", "5151319f99abfc15f9a1aab05c799faf3b0e5715fac5a5812b9d3566ae984374"),
    ("BSD-2-Clause", 186, "redistribution and use in", "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30"),
    ("BSD-3-Clause", 211, "redistribution and use in", "d0a339eb5454123c6a1f2696aace557e0561866f3fe33b93ffad58ecfcab7060"),
    ("BSD-3-Clause", 214, "redistribution and use in", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("BSD-3-Clause", 214, "redistribution and use in", "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa"),
    ("BSD-3-Clause", 214, "redistribution and use in", "b6ab7953b6c80a72261014244324a70663f1807fa212f52461b24c95eb16b4a9"),
    ("BSD-3-Clause", 217, "redistribution and use in", "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2"),
    ("BSD-3-Clause", 217, "redistribution and use in", "cc3432eb2f19bb6fe96706bad75b6fce1039db64fb70486899bf6425dea4d9cb"),
    ("CC0-1.0", 1008, "statement of purpose the", "4f8ab63ace774f37529081c81e2730a88143bf70e67392bd3c3701bd0a175152"),
    ("GFDL-1.2", 3072, "0 preamble the purpose", "161fd307ef3aeb1768b25062a87f5da94a0e2ba2269f5fc3abf62ac5ec3c0e90"),
    ("GFDL-1.3", 3495, "0 preamble the purpose", "e129149479c29f64ac690bb4349233c72abdf75d18b0e15e40a732c6449150a2"),
    ("GPL-1.0", 1235, "0 this license agreement", "061a29d66423037cdc5603340c058a06fde9763cafab1f532a6ed57cd3a514d5"),
    ("GPL-1.0", 1240, "0 this license agreement", "62f899ce3dcfbe979aa13b91d2cc3747693edb153465273224804803abf0d8e6"),
    ("GPL-2.0", 2014, "0 this license applies", "18c80b89f52dfade19e85841a3c7ccb098438b8bcd051003334df313c8768777"),
    ("GPL-2.0", 2019, "0 this license applies", "1a0524000c0190cf8019a4a5f65feced5a540034c263305187bca508946746a0"),
    ("GPL-3.0", 4645, "0 definitions this license", "55c5278e056aae797ea003e141fd285b5f9c26885b62e1a274a7fbe5b31d03ae"),
    ("GPL-3.0", 4650, "0 definitions this license", "9d22b93423c1287ac7de053daa60b444c83de405523cfeda5b51a5ecbb95b56d"),
    ("ISC", 112, "permission to use copy", "217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a"),
    ("LGPL-2.0", 2968, "0 this license agreement", "4f66212c21abee9797b911bbb50f6c0f223a984ed7daad75f4127743e6bcd3aa"),
    ("LGPL-2.0", 2973, "0 this license agreement", "f7344413883843e7d1573de4503a655db51fac962f28637faea5aab17cdb96cd"),
    ("LGPL-2.1", 3051, "0 this license agreement", "b3f73bf7fd15294609beadb407fc4b2c25835d6aee904324032582bf18130904"),
    ("LGPL-2.1", 3056, "0 this license agreement", "4a9e77d344bd3c1d1c3896678e8fa85edcf80961b089b307ba0db8c826a6dcb7"),
    ("LGPL-3.0", 1202, "this version of the", "3c109b32fc12cedb18f514c338498353cbbafbc7ad3aa3aed8c864396943f25a"),
    ("MIT", 163, "permission is hereby granted", "0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c"),
    ("MPL-1.1", 3520, "1 definitions 1 0", "4fbf4b1f3d8cf5d05e627fcb1b0dded60f72dbb2e5c2bc5bb929a8db71982f2d"),
    ("MPL-2.0", 2293, "1 definitions 1 1", "8f27174c93cb7f68399e5e71af858fdef9c2151b9de96b0dd9bab40a165711b3"),
    ("Unlicense", 191, "this is free and", "e6e60d2037efe58841d698b341a609d8a738effceaadb12ac721e54f8e0bf7db"),
    ("Unlicense", 199, "this is free and", "788cc8843bf483eb3ea3b5f6c317b95502da6e7105963f7c57c872ceb263fd49"),
)
